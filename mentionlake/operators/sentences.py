"""Texts to sentences, and table blocks to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionlake.functions.text import WS, sentence_array, strip
from mentionlake.operators.anchors import anchor_filter
from mentionlake.operators.sizing import broadcast_if_small
from mentionlake.session import stored

#: An abbreviation's least score, and the share of its uses that end in a dot if it is one.
MIN_SCORE = 0.3
DOTTED_SHARE = 0.99
#: Learnt words that are one literal of the plan; a longer list is joined.
MOST_IN_PLAN = 5_000


def split_sentences(texts: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, sent_no, sentence``; numbering counts every piece, empty ones are dropped."""
    return (
        texts.select(key, F.posexplode_outer(sentence_array(F.col(text))).alias("sent_no", "sentence"))
        .where(F.col("sentence") != "")
    )


def split_rows(tables: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """A table block is searched line by line."""
    return (
        tables.select(key, F.posexplode_outer(F.split(F.col(text), "\n")).alias("sent_no", "sentence"))
        .withColumn("sentence", strip(F.col("sentence")))
        .where(F.col("sentence") != "")
    )


def dotted_word(token: Column) -> Column:
    """The lower-cased word a token ends with, without the dot behind it and the brackets
    and quotes around it; inner dots stay. Empty where there is no letter."""
    bare = F.regexp_replace(F.lower(token), r"^[\"'(\[]+|[\"')\],;:!?]+$", "")
    bare = F.regexp_replace(bare, r"\.$", "")
    return F.when(F.rlike(bare, F.lit(r"^\p{L}[\p{L}.-]*$")), bare).otherwise("")


def _last_token(c: Column) -> Column:
    """White space of any kind parts tokens; the last is in what follows the last plain space."""
    return F.element_at(F.split(F.substring_index(c, " ", -1), f"{WS}+"), -1)


def learn_abbreviations(
    texts: DataFrame, text: str = "text", min_score: float = MIN_SCORE, most: int | None = None
) -> DataFrame:
    """``word, dotted, plain, score``: words that nearly always carry a dot, all of them or,
    only when asked, the ``most`` best.

    No labels are needed. A word's uses with and without a dot behind it are compared under
    two hypotheses, that it is an abbreviation (``DOTTED_SHARE`` of its uses end in a dot)
    and that dots follow it as they follow any word. The log-likelihood ratio is weighed
    down for long words, raised for inner dots, and falls with every use without the dot.
    Words met before a line's end only are no evidence: the last token of a text counts
    for nothing. Equal stretches are counted first and taken apart once, not at each use.
    """
    flat = strip(F.col(text))
    # What stands between plain spaces is counted first; the last token, behind a space, is taken off.
    stretches = F.concat(F.split(flat, " "), F.array(F.concat(F.lit(" "), _last_token(flat))))
    rows = texts.select(F.explode_outer(stretches).alias("stretch")).where("stretch is not null")
    rows = rows.groupBy("stretch").agg(F.count("*").alias("n"))
    uses = F.when(F.startswith("stretch", F.lit(" ")), -F.col("n")).otherwise(F.col("n")).alias("uses")
    rows = rows.select(uses, F.explode_outer(F.split(F.ltrim("stretch"), f"{WS}+")).alias("token")).where("token <> ''")
    dot = F.rlike("token", F.lit(r"\.[\"')\]]*$"))
    rows = rows.select(dotted_word(F.col("token")).alias("word"), F.when(dot, F.col("uses")).otherwise(0).alias("dotted"), "uses")
    counts = rows.where("word <> ''").groupBy("word").agg(
        F.sum("dotted").alias("dotted"), F.sum(F.col("uses") - F.col("dotted")).alias("plain")
    )
    whole = counts.agg((F.sum("dotted") / (F.sum("dotted") + F.sum("plain"))).alias("share"))
    share = F.least(F.greatest(F.col("share"), F.lit(1e-9)), F.lit(1 - 1e-9))
    d, u = F.col("dotted").cast("double"), F.col("plain").cast("double")
    ratio = 2 * (d * (F.log(F.lit(DOTTED_SHARE)) - F.log(share)) + u * (F.log(F.lit(1 - DOTTED_SHARE)) - F.log(1 - share)))
    letters = F.length(F.replace("word", F.lit(".")))
    inner_dots = F.length("word") - letters
    score = ratio * F.exp(-letters.cast("double")) * (inner_dots + 1) * F.exp(-u)
    # One row meets the counts.
    scored = counts.where("dotted > 0").join(F.broadcast(whole)).select("word", "dotted", "plain", F.round(score, 6).alias("score"))
    found = scored.where(F.col("score") >= min_score)
    return found if most is None else found.orderBy(F.desc("score"), "word").limit(most)


def _learnt_of_key(texts: DataFrame, abbreviations: DataFrame, text: str, key: str) -> DataFrame:
    """``_key, _learnt``: the learnt words that end a piece in the texts of a key."""
    learnt = stored(abbreviations.select("word"), "learnt-words")
    passes = anchor_filter(learnt.withColumnRenamed("word", "anchor"))
    dotted = F.filter(sentence_array(F.col(text)), lambda p: F.endswith(p, F.lit(".")))
    ends = F.filter(F.array_distinct(F.transform(dotted, lambda p: dotted_word(_last_token(p)))), passes)
    told = texts.select(F.col(key).alias("_key"), F.explode_outer(ends).alias("word")).where("word is not null")
    return told.join(broadcast_if_small(learnt), "word", "left_semi").groupBy("_key").agg(F.collect_set("word").alias("_learnt"))


def split_learned(
    texts: DataFrame, abbreviations: DataFrame, text: str = "text", key: str = "doc_id", most_in_plan: int = MOST_IN_PLAN
) -> DataFrame:
    """``key, sent_no, sentence`` as :func:`split_sentences` gives them, but a break behind
    a learnt abbreviation (``word``) is none. Two words in a row, as in "et al.", are told
    by the last. Up to ``most_in_plan`` learnt words are one literal of the plan, so texts are
    cut where they are read. Of a longer list each text meets those that end a piece of it."""
    words = [r["word"] for r in abbreviations.select("word").orderBy("word").limit(most_in_plan + 1).collect()]
    if len(words) <= most_in_plan:
        rows, is_learnt = texts, lambda word: word.isin(words)
    else:
        told = _learnt_of_key(texts, abbreviations, text, key)
        rows = texts.select(key, text).join(told, F.col(key).eqNullSafe(F.col("_key")), "left")
        is_learnt = lambda word: F.coalesce(F.array_contains("_learnt", word), F.lit(False))

    def runs_on(piece: Column) -> Column:
        return F.when(F.endswith(piece, F.lit(".")), is_learnt(dotted_word(_last_token(piece)))).otherwise(False)

    # No piece holds a line break, so one may stand between sentences.
    ended = F.transform(sentence_array(F.col(text)), lambda p: F.concat(p, F.when(runs_on(p), " ").otherwise("\n")))
    whole = F.array_join(ended, "")
    pieces = F.split(F.substring(whole, F.lit(1), F.length(whole) - 1), "\n")
    return rows.select(key, F.posexplode_outer(pieces).alias("sent_no", "sentence")).where(F.col("sentence") != "")
