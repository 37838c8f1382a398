"""Alias mentions in sentences: anchor join, suppression, volume re-check, dedupe."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mentionlake.functions.text import DASH, FOLDS_TO_ASCII, WS_CHARS, ascii_lower, letter_runs, letter_runs_in_order
from mentionlake.operators.anchors import SLICE_ROWS, anchor_filter, anchor_join, each_salt, salted_pairs, salts_of
from mentionlake.operators.dictionary import (
    ANYWHERE,
    GRAM,
    GRAM_LENGTH,
    alias_patterns,
)
from mentionlake.operators.sentences import split_sentences
from mentionlake.operators.sizing import MAX_ROWS, measure, row_bytes
from mentionlake.session import stored

VOLUME_THRESHOLD = 30
FEW_GRAMS = 32
ALIAS_FIELDS = ["resource_id", "resource_name", "alias", "literal"]
SPELLED = ["alias", "case_sensitive"]
#: About as many resources that share an alias are one row of the join with its matches.
OWNERS_PER_ROW = 1_000


def _boundaries(body: Column, boundary: str) -> Column:
    if boundary == "lookaround":
        return F.concat(F.lit("(?<![A-Za-z])"), body, F.lit("(?![A-Za-z])"))
    return F.concat(F.lit("[^A-Za-z]"), body, F.lit("[^A-Za-z]"))


def _grams(c: Column) -> Column:
    """Short pieces of the stretches that are neither letters, spaces, dots nor dashes."""
    solid = F.filter(F.split(c, f"[{WS_CHARS}.A-Za-z{DASH[1:]}+"), lambda s: s != "")

    def pieces(s):
        starts = F.sequence(F.lit(1), F.length(s))
        cut = [lambda i, n=n: F.concat(F.lit(GRAM), s.substr(i, F.lit(n))) for n in range(1, GRAM_LENGTH + 1)]
        return F.flatten(F.transform(starts, lambda i: F.array(*[f(i) for f in cut])))

    return F.flatten(F.transform(solid, pieces))


def _side_by_side(runs: Column) -> Column:
    """A run and the next one, a space between them; ``runs`` is never empty."""
    return F.zip_with(F.slice(runs, 1, F.size(runs) - 1), F.slice(runs, 2, F.size(runs)), lambda a, b: F.concat(a, F.lit(" "), b))


def _sentence_tokens(special: list[str], in_order: bool = False) -> Column:
    """Distinct tokens, or the letter runs ``in_order`` with repeats and the other tokens
    behind them, an empty one between what does not stand side by side."""
    sentence, lowered = F.col("sentence"), F.col("lowered")
    # Case-sensitive aliases need the runs of the unlowered text; they differ only here.
    if in_order:
        tokens, gap = letter_runs_in_order(lowered), F.array(F.lit(""))
        both = F.concat(tokens, gap, letter_runs_in_order(ascii_lower(sentence)))
        tokens = F.concat(F.when(F.col("folds"), both).otherwise(tokens), gap)
    else:
        tokens = letter_runs(lowered)
        tokens = F.when(
            F.col("folds"), F.array_union(tokens, letter_runs(ascii_lower(sentence)))
        ).otherwise(tokens)
    if len(special) > FEW_GRAMS:  # the list is cut, so cut all pieces of the sentence
        grams = F.array_union(_grams(lowered), _grams(sentence))
        return F.concat(tokens, grams, F.array(F.lit(ANYWHERE)))
    if not special:
        return tokens
    # A handful of letterless aliases: look for their pieces instead of cutting all pieces.
    seen = [
        F.when(
            F.lit(True) if a == ANYWHERE else lowered.contains(a[1:]) | sentence.contains(a[1:]),
            F.lit(a),
        )
        for a in special
    ]
    # Dropping the nulls would keep the whole step out of generated code.
    seen = F.array(*[F.coalesce(a, F.lit("")) for a in seen]) if in_order else F.array_compact(F.array(*seen))
    return F.concat(tokens, seen)


def _hits(boundary: str) -> Column:
    if boundary == "lookaround":
        subject = F.when(F.col("case_sensitive"), F.col("sentence")).otherwise(F.col("lowered"))
    else:
        # The older matcher looks at the lowered sentence in both modes.
        subject = F.col("lowered")
    # A whole token equal to a one-word alias is a match, if it is one of the lowered text.
    proven = F.col("plain") & ~F.col("folds")
    return proven | F.rlike(subject, _boundaries(F.col("core"), boundary))


def _with_tokens(rows: DataFrame, special: list[str], in_order: bool = False) -> DataFrame:
    rows = rows.withColumn("lowered", F.lower("sentence")).withColumn("folds", F.col("sentence").rlike(FOLDS_TO_ASCII))
    return rows.withColumn("tokens", _sentence_tokens(special, in_order))


def match_aliases(
    sentences: DataFrame,
    aliases: DataFrame,
    boundary: str = "lookaround",
    key: str = "doc_id",
    max_rows: int = MAX_ROWS,
    token_counts: DataFrame | None = None,
) -> DataFrame:
    """Every (sentence, alias) pair where the alias occurs, once.

    Sentences are exploded to distinct tokens and joined to aliases on an anchor token;
    the regex runs on the pairs that share one. A dictionary within ``max_rows`` is
    broadcast, so sentences are not shuffled. Of a larger one the distinct aliases are matched,
    and resources that share one join the matches last: what is shuffled does not grow with
    the number of resources that have a name. See :func:`_match_large`.
    """
    each = aliases.groupBy(*SPELLED).agg(F.count("*").alias("copies"), F.sum(row_bytes(aliases.drop(*SPELLED))).alias("more"))
    spellings = alias_patterns(each, boundary, token_counts)
    anchor = F.col("anchors")[0]
    letterless = anchor.startswith(GRAM) | (anchor == ANYWHERE)
    distinct = spellings.withColumn("anchor", F.explode("anchors")).drop("norm")
    size = measure(distinct, max_rows, mark=letterless, copies="copies", more="more")
    special = []
    if size.marked:
        found = spellings.where(letterless).select(anchor.alias("a")).distinct()
        special = [r["a"] for r in found.limit(FEW_GRAMS + 1).collect()]
    sentences = sentences.select(key, "sent_no", "sentence")
    # Counts of letter runs do not cover letterless anchors; with such, tokens are counted anew.
    counts = None if token_counts is None or size.marked else token_counts.withColumnRenamed("token", "anchor")
    if not size.fits:
        return _match_large(sentences, aliases, boundary, key, token_counts, special, counts, size.most)
    by_anchor = alias_patterns(aliases, boundary, token_counts).withColumn("anchor", F.explode("anchors")).drop("norm")
    rows = _with_tokens(sentences, special)
    pairs = anchor_join(rows, [key, "sent_no"], F.col("tokens"), by_anchor, True)
    return pairs.where(_once() & _hits(boundary)).select(key, "sent_no", "sentence", *ALIAS_FIELDS)


def _once() -> Column:
    """Several anchors of one alias may be in a sentence; the first of them counts."""
    return (F.size("anchors") == 1) | (F.col("anchor") == F.array_intersect("anchors", "tokens")[0])


def _match_large(
    sentences: DataFrame, aliases: DataFrame, boundary: str, key: str,
    token_counts: DataFrame | None, special: list[str], counts: DataFrame | None, most_owners: int,
) -> DataFrame:
    """Matches of a dictionary that is too large to broadcast.

    An alias of several words is anchored on two that stand side by side, so that a sentence
    meets few aliases that it does not hold. Tokens that may be an anchor are stored with
    their sentence: texts are cut once, though tokens are counted and joined, and a sentence
    is searched where its token meets an alias. Resources that share an alias and a name
    are gathered into rows of about ``OWNERS_PER_ROW``.
    """
    spark = sentences.sparkSession
    slice_no = F.pmod(F.xxhash64("resource_id"), F.lit(max(1, math.ceil(most_owners / OWNERS_PER_ROW))))
    gathered = aliases.groupBy(*SPELLED, "resource_name", slice_no.alias("slice")).agg(F.collect_list(F.struct("resource_id")).alias("owners"))
    gathered = gathered.withColumn("owners", F.col("owners.resource_id"))
    by_anchor = stored(alias_patterns(gathered, boundary, token_counts, token_counts is None), "aliases")
    by_anchor = by_anchor.withColumn("anchor", F.explode("anchors")).drop("norm", "slice")
    distinct = by_anchor.drop("resource_name", "owners").dropDuplicates([*SPELLED, "anchor"])
    rows = stored(_anchor_tokens(_with_tokens(sentences, special, True), key, anchor_filter(distinct)), "tokens")
    if counts is None:
        counts = rows.groupBy("anchor").agg(F.count("*").alias("n"))
    salts = salts_of(counts, SLICE_ROWS)
    pairs = salted_pairs(rows, [key, "sent_no", "sentence", "folds"], F.array("anchor"), distinct, salts)
    pairs = pairs.withColumn("lowered", F.lower("sentence")).withColumn("tokens", _sentence_tokens(special))
    joined = ["anchor", "salt", *SPELLED]
    hits = pairs.where(_once() & _hits(boundary)).select(key, "sent_no", "sentence", *joined, "literal")
    # Few bytes come in and many rows may go out, so tasks are not merged by their bytes.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    owners = each_salt(by_anchor.select(*SPELLED, "anchor", "resource_name", "owners"), salts)
    found = hits.repartition(tasks, *joined).join(owners, joined)
    found = found.select(key, "sent_no", "sentence", F.explode("owners").alias("resource_id"), "resource_name", "alias", "literal")
    return found.select(key, "sent_no", "sentence", *ALIAS_FIELDS)


def _anchor_tokens(rows: DataFrame, key: str, passes: Callable[[Column], Column]) -> DataFrame:
    """``anchor`` with its sentence, once for each token or two neighbours that pass."""
    token, place = F.col("token"), F.col("place")
    pair = F.concat(token, F.lit(" "), F.coalesce(F.get("tokens", place + 1), F.lit("")))
    each = rows.select(key, "sent_no", "sentence", "folds", "tokens", F.posexplode_outer("tokens").alias("place", "token"))
    each = each.where(passes(token) | passes(pair))
    first = [
        F.when(passes(c) & (F.array_position(of, c) == place + 1), c)
        for c, of in ((token, F.col("tokens")), (pair, _side_by_side(F.col("tokens"))))
    ]
    anchors = each.select(key, "sent_no", "sentence", "folds", F.explode_outer(F.array(*first)).alias("anchor"))
    return anchors.where("anchor is not null")


def token_counts(sentences: DataFrame) -> DataFrame:
    """``token, n``: in how many sentences each letter run occurs. Worth one pass where a
    dictionary has many aliases of common words; store the result and reuse it."""
    tokens = letter_runs(F.lower("sentence"))
    rows = sentences.select(F.explode_outer(tokens).alias("token")).where(F.col("token") != "")
    return rows.groupBy("token").agg(F.count("*").alias("n"))


def suppress_substrings(pairs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Inside one sentence drop each mention whose lowered alias is a proper part of
    another matched lowered alias; equal lowered aliases keep each other. A sentence's
    mentions are gathered into one row before the shuffle already."""
    rows = pairs.groupBy(key, "sent_no").agg(
        F.any_value("sentence").alias("sentence"),
        F.collect_set(F.struct(*ALIAS_FIELDS)).alias("found"),
    )
    rows = rows.withColumn("all_lowered", F.transform("found", lambda m: F.lower(m["alias"])))
    kept = F.filter(
        "found",
        lambda m: ~F.exists(
            "all_lowered",
            lambda other: (other != F.lower(m["alias"])) & F.contains(other, F.lower(m["alias"])),
        ),
    )
    return rows.select(key, "sent_no", "sentence", F.inline(kept))


def recheck_volume(
    mentions: DataFrame,
    case_sensitive: Sequence[str] = (),
    threshold: int = VOLUME_THRESHOLD,
    boundary: str = "lookaround",
    key: str = "doc_id",
) -> DataFrame:
    """Where an alias has more than ``threshold`` mentions in an article, counted over
    all resources that share it, keep only strict case-sensitive ones. An alias equal
    to a listed resource name is exempt (the older matcher exempts none)."""
    n = F.count("*").over(Window.partitionBy(key, "alias"))
    exempt = F.col("alias").isin(list(case_sensitive)) if boundary == "lookaround" else F.lit(False)
    strict = F.rlike("sentence", _boundaries(F.col("literal"), boundary))
    return (
        mentions.withColumn("alias_hits", n)
        .where((F.col("alias_hits") <= threshold) | exempt | strict)
    )


def dedupe_mentions(mentions: DataFrame, key: str = "doc_id") -> DataFrame:
    """Distinct sentences per article, alias and resource; the first position stays."""
    return (
        mentions.where(F.col("sentence") != "")
        .groupBy(key, "sentence", "alias", "resource_name")
        .agg(F.min("sent_no").alias("sent_no"), F.min("resource_id").alias("resource_id"))
        .select(key, "sent_no", "sentence", "resource_id", "resource_name", "alias")
    )


def find_mentions(
    sentences: DataFrame,
    aliases: DataFrame,
    case_sensitive: Sequence[str] = (),
    threshold: int = VOLUME_THRESHOLD,
    boundary: str = "lookaround",
    key: str = "doc_id",
    max_rows: int = MAX_ROWS,
    token_counts: DataFrame | None = None,
) -> DataFrame:
    """Match, suppress, re-check and dedupe. Sentences are shuffled only where they hold
    a mention: once by sentence, once by article and alias. ``max_rows`` and
    ``token_counts`` go to :func:`match_aliases`."""
    matched = match_aliases(sentences, aliases, boundary, key, max_rows, token_counts)
    kept = suppress_substrings(matched, key)
    return dedupe_mentions(recheck_volume(kept, case_sensitive, threshold, boundary, key), key)


def find_in_texts(
    texts: DataFrame, aliases: DataFrame, case_sensitive: Sequence[str] = (), **options
) -> DataFrame:
    return find_mentions(split_sentences(texts), aliases, case_sensitive, **options)
