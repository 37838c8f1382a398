"""Training data: block labels, quota sampling, splits, token windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mentionlake.functions.ids import hash32
from mentionlake.functions.text import strip
from mentionlake.operators.articles import phrase_hits
from mentionlake.operators.dictionary import escape_regex
from mentionlake.operators.ranking import below_nth, top_n_per_key
from mentionlake.operators.score import model_input
from mentionlake.operators.sentences import split_sentences

POSITIVES = 20
NEGATIVES = 20
PER_ARTICLE = 5
SKIP_AFTER = 200
TRAIN_ROWS = 1200
SEED = 42


def eligible_aliases(definitions: DataFrame) -> DataFrame:
    """``resource_id, resource_name, alias, topics`` of definitions that have topics and
    are not marked unambiguous (0); the mark defaults to 1."""
    rows = definitions.where(
        (F.size("topics") > 0) & (F.coalesce("ambiguous", F.lit(1)) != 0)
    )
    return rows.select(
        F.col("names")[0].alias("resource_id"),
        F.col("names")[0].alias("resource_name"),
        F.explode("names").alias("alias"),
        F.transform("topics", F.lower).alias("topics"),
    )


def _topic_pattern(topic: Column) -> Column:
    edge = r"[^\p{L}\p{N}_]"
    return F.concat(F.lit(f"(^|{edge})"), escape_regex(topic), F.lit(f"e?s?({edge}|$)"))


def topic_matches(texts: DataFrame, definitions: DataFrame) -> DataFrame:
    """Articles with each alias they hold as a phrase, and whether any topic of the
    resource occurs anywhere in the text: ``doc_id, text, resource_name, alias, topics,
    article_topic_match``."""
    rows = phrase_hits(texts, eligible_aliases(definitions)).drop("resource_id")
    topic = F.exists("topics", lambda t: F.contains("lowered", t))
    flagged = rows.withColumn("lowered", F.lower("text")).withColumn("article_topic_match", topic)
    return flagged.drop("lowered")


def article_topic(texts: DataFrame, definitions: DataFrame) -> DataFrame:
    return topic_matches(texts, definitions).drop("text", "topics")


def label_blocks(texts: DataFrame, definitions: DataFrame) -> DataFrame:
    """Blocks (sentences) that contain an alias, anywhere and in any case: label 1 where
    a topic of the resource stands in the block as a word, else 0. Each text is cut where
    it was read; nothing is shuffled."""
    docs = topic_matches(texts, definitions)
    about = F.struct("doc_id", "resource_name", "alias", "topics", "article_topic_match")
    rows = (
        split_sentences(docs.select(about.alias("about"), "text"), key="about")
        .select("about.*", "sent_no", "sentence", F.lower("sentence").alias("lowered"))
        .where(F.contains("lowered", F.lower("alias")))
    )
    topic = F.exists("topics", lambda t: F.rlike("lowered", _topic_pattern(t)))
    return rows.select(
        "resource_name",
        "alias",
        topic.cast("int").alias("label"),
        "article_topic_match",
        "doc_id",
        F.col("sent_no").alias("block_no"),
        F.col("sentence").alias("paragraph_text"),
    )


def quota_sample(
    labelled: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    per_article: int = PER_ARTICLE,
    skip_after: int = SKIP_AFTER,
    seed: int = SEED,
) -> DataFrame:
    """Examples per alias, taken greedily article by article until both quotas are full.

    An article gives at most ``per_article`` examples; a block whose quota is full does
    not use one up. Articles come in a seeded hash order. An alias that lacks one label
    after ``skip_after`` articles gives nothing.

    Only the first ``per_article`` blocks of a label in an article, and the first few
    articles with that label, can ever be taken: an article yields none of a label only
    after ``per_article`` of the other, which its quota allows a few times. Two ranking
    filters, applied before the shuffle too, cut each alias to a fixed number of rows
    however common it is; the greedy pass then folds over that short list. The input is
    read more than once: pass a stored table.
    """
    alias = ["resource_name", "alias"]
    order = F.md5(F.concat_ws("|", F.lit(seed), "alias", F.col("doc_id").cast("string")))
    rows = labelled.withColumn("art", order)

    seen = rows.select(*alias, "doc_id", "art").distinct()
    early = top_n_per_key(seen, alias, [F.col("art"), F.col("doc_id")], skip_after)
    early = early.select(*alias, "doc_id", F.lit(True).alias("early"))

    few = top_n_per_key(rows, [*alias, "label", "doc_id"], [F.col("block_no")], per_article)
    need = F.when(F.col("label") == 1, positives + negatives // per_article).otherwise(
        negatives + positives // per_article
    )
    most = max(positives + negatives // per_article, negatives + positives // per_article)
    w = Window.partitionBy(*alias, "label").orderBy("art", "doc_id")
    few = few.withColumn("art_rank", F.dense_rank().over(w)).where(F.col("art_rank") <= most)
    few = few.where(F.col("art_rank") <= need).drop("rank_in_key", "art_rank")
    few = few.join(early, [*alias, "doc_id"], "left")

    fields = ["art", "doc_id", "block_no", "label", "early", "article_topic_match", "paragraph_text"]
    short = few.groupBy(*alias).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("rows"))

    start = F.struct(
        F.lit(0).alias("pos"),
        F.lit(0).alias("neg"),
        F.lit("").alias("art"),
        F.lit(0).alias("used"),
        F.array().cast("array<int>").alias("taken"),
        F.lit(False).alias("early_pos"),
        F.lit(False).alias("early_neg"),
    )

    def step(acc, row):
        is_pos = row["label"] == 1
        used = F.when(row["art"] == acc["art"], acc["used"]).otherwise(F.lit(0))
        room = F.when(is_pos, acc["pos"] < positives).otherwise(acc["neg"] < negatives)
        take = room & (used < per_article)
        early = take & F.coalesce(row["early"], F.lit(False))
        return F.struct(
            (acc["pos"] + F.when(take & is_pos, 1).otherwise(0)).alias("pos"),
            (acc["neg"] + F.when(take & ~is_pos, 1).otherwise(0)).alias("neg"),
            row["art"].alias("art"),
            (used + F.when(take, 1).otherwise(0)).alias("used"),
            F.when(take, F.array_append(acc["taken"], row["i"])).otherwise(acc["taken"]).alias("taken"),
            (acc["early_pos"] | (early & is_pos)).alias("early_pos"),
            (acc["early_neg"] | (early & ~is_pos)).alias("early_neg"),
        )

    numbered = F.transform(
        "rows",
        lambda r, i: F.struct(
            i.alias("i"), r["label"].alias("label"), r["art"].alias("art"), r["early"].alias("early")
        ),
    )
    folded = short.withColumn("end", F.aggregate(numbered, start, step))
    kept = F.filter("rows", lambda r, i: F.array_contains("end.taken", i))
    return folded.where("end.early_pos and end.early_neg").select(*alias, F.inline(kept)).select(
        *alias, "label", "article_topic_match", "doc_id", "block_no", "paragraph_text"
    )


def split_first_n(rows: DataFrame, key: str, n: int = TRAIN_ROWS, seed: int = SEED) -> DataFrame:
    """Adds ``split``: the first ``n`` rows of a seeded shuffle train, the rest test.
    ``key`` is unique per row; the shuffle is a hash order, stable on every rerun."""
    h = hash32(F.lit(seed), F.col(key))
    hashed = rows.withColumn("_h", h)
    train = below_nth(hashed, "_h", key, n, buckets_of=65_536)
    return hashed.withColumn("split", F.when(train, "train").otherwise("test")).drop("_h")


def split_by_hash(rows: DataFrame, key: str, train_share: float = 0.8, seed: int = SEED) -> DataFrame:
    cut = int(round(train_share * 2**32))
    train = hash32(F.lit(seed), F.col(key)) < cut
    return rows.withColumn("split", F.when(train, "train").otherwise("test"))


def order_by_label(rows: DataFrame) -> DataFrame:
    """All keys compare as text, so a flag sorts as ``False`` before ``True``."""
    flag = F.initcap(F.col("article_topic_match").cast("string"))
    return rows.orderBy(
        F.col("label").cast("string"), flag, F.col("pmcid").cast("string"), "resource_name", "alias"
    )


def with_model_input(rows: DataFrame) -> DataFrame:
    return rows.withColumn("input_text", model_input(F.col("paragraph_text"), F.col("alias")))


def token_windows(
    rows: DataFrame, text: str = "text", length: int = 512, overlap: int = 128
) -> DataFrame:
    """Overlapping windows of whitespace-separated tokens; every other column, the label
    among them, is kept on each window. ``padding`` is what the last one lacks."""
    keep = [c for c in rows.columns if c != text]
    step = length - overlap
    tokens = F.filter(F.split(strip(F.col(text)), r"\s+"), lambda t: t != "")
    base = rows.select(*keep, tokens.alias("tokens"))
    last = F.ceil(F.greatest(F.size("tokens") - length, F.lit(0)) / step).cast("int")
    windows = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.slice("tokens", i * step + 1, length)
    )
    cut = base.select(*keep, F.posexplode_outer(windows).alias("window_no", "window"))
    return cut.withColumn("n_tokens", F.size("window")).withColumn(
        "padding", F.lit(length) - F.col("n_tokens")
    )
