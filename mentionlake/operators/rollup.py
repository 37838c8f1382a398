"""Roll-ups of scored mentions: summaries, prediction counts, specificity, facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mentionlake.operators.score import MICRO, MIN_CONFIDENCE, confident
from mentionlake.operators.sizing import broadcast_if_small

#: Registers of a distinct-count sketch, as a power of two.
SKETCH_BITS = 14
FACT_KEY = ["pmcid", "resource_id", "matched_alias", "version"]


def _mean_confidence():
    """Mean over whole millionths: the sum does not depend on the order of rows."""
    micro = F.round(F.col("confidence") * MICRO).cast("bigint")
    return F.round(F.sum(micro) / F.count("*") / F.lit(float(MICRO)), 6)


def summarise(
    scored: DataFrame,
    keys: Sequence[str] = ("doc_id", "resource_name", "alias"),
    min_confidence: float = MIN_CONFIDENCE,
    sentences: bool = False,
) -> DataFrame:
    """Confident positive mentions per ``keys``: how many, and their mean confidence.
    Rows with a null key are dropped. ``sentences`` adds the distinct sentences, sorted
    and joined, at grains that include the article."""
    if sentences and not {"doc_id", "pmcid"} & set(keys):
        raise ValueError("sentences can only be joined per article")
    rows = scored.where(confident(min_confidence)).dropna(subset=list(keys))
    aggs = [F.count("*").alias("match_count"), _mean_confidence().alias("mean_confidence")]
    if sentences:
        joined = F.array_join(F.array_sort(F.collect_set("sentence")), " || ")
        aggs.append(joined.alias("token_matches"))
    return rows.groupBy(*keys).agg(*aggs)


def prediction_counts(
    scored: DataFrame, keys: Sequence[str] = ("resource_name", "alias", "prediction")
) -> DataFrame:
    return scored.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("n"))


def merge_counts(partials: DataFrame) -> DataFrame:
    return partials.groupBy("resource_name", "alias", "prediction").agg(F.sum("n").alias("n"))


def specificity(counts: DataFrame) -> DataFrame:
    """Share of positive predictions per resource and alias; both classes always get a
    column, also when one never occurs."""
    wide = (
        counts.groupBy("resource_name", "alias")
        .pivot("prediction", [0, 1])
        .agg(F.sum("n"))
        .na.fill(0, ["0", "1"])
    )
    neg, pos = F.col("0").cast("bigint"), F.col("1").cast("bigint")
    return wide.select(
        "resource_name",
        "alias",
        neg.alias("negatives"),
        pos.alias("positives"),
        F.round(pos / (pos + neg), 6).alias("specificity"),
    )


def top_specificity(scores: DataFrame, n: int) -> DataFrame:
    """Most specific first, then most positives; names break ties."""
    order = [F.desc("specificity"), F.desc("positives"), "resource_name", "alias"]
    return scores.orderBy(*order).limit(n)


def mention_counters(scored: DataFrame, key: str = "doc_id") -> DataFrame:
    return scored.groupBy(key).agg(
        F.count("*").alias("mentions"), F.count_distinct("resource_name").alias("resources")
    )


def sketch_counters(scored: DataFrame, by: Sequence[str], of: str = "doc_id", bits: int = SKETCH_BITS) -> DataFrame:
    """Partial counters that can be merged: ``mentions`` and a sketch of the distinct values
    of ``of`` for each ``by``. A partial takes a few kilobytes however many values it saw, so
    chunks and days are kept and merged without their rows. Null values count as none."""
    return scored.groupBy(*by).agg(F.count("*").alias("mentions"), F.hll_sketch_agg(of, bits).alias("sketch"))


def merge_sketches(partials: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by, mentions, sketch`` of partial counters at a finer grain."""
    return partials.groupBy(*by).agg(F.sum("mentions").alias("mentions"), F.hll_union_agg("sketch").alias("sketch"))


def sketch_error(bits: int = SKETCH_BITS) -> float:
    """The relative standard error of an estimate."""
    return 1.04 / 2 ** (bits / 2)


def estimated_counters(partials: DataFrame) -> DataFrame:
    """``sketch`` replaced by its estimate, ``distinct_estimate``."""
    estimate = F.hll_sketch_estimate("sketch").alias("distinct_estimate")
    return partials.select(*[c for c in partials.columns if c != "sketch"], estimate)


def rank_mentions(scored: DataFrame, key: str = "doc_id") -> DataFrame:
    """Order within an article: predicted matches first, then by confidence."""
    w = Window.partitionBy(key).orderBy(
        F.desc("prediction"), F.desc("confidence"), "sent_no", "resource_name", "alias"
    )
    return scored.withColumn("rank_in_article", F.row_number().over(w))


def mention_facts(summary: DataFrame, articles: DataFrame, version: dict) -> DataFrame:
    """Summary rows of articles that passed the gate, stamped with the run version.

    ``summary`` is per ``pmcid, resource_id, resource_name, alias``; ``articles`` has a
    row per ``pmcid`` with its ``title``.
    """
    return summary.join(articles.select("pmcid", "title"), "pmcid").select(
        "pmcid",
        "title",
        "resource_id",
        F.col("resource_name").alias("short_name"),
        F.col("alias").alias("matched_alias"),
        "match_count",
        "mean_confidence",
        F.lit(version["name"]).alias("version"),
        F.lit(version["date"]).alias("version_date"),
        F.lit(version["user"]).alias("version_user"),
    )


def new_facts(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows to append: one per key, keys already stored are left alone."""
    once = incoming.dropDuplicates(FACT_KEY)
    return once.join(existing.select(*FACT_KEY), FACT_KEY, "left_anti")


def with_resource_ids(summary: DataFrame, lookup: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Look up ids by name for summaries that carry none; the second frame holds what
    has no id."""
    named = broadcast_if_small(lookup.withColumnRenamed("alias", "resource_name"))
    rows = summary.join(named, "resource_name", "left")
    missing = rows.where(F.col("resource_id").isNull()).withColumn("reason", F.lit("no resource id"))
    return rows.where(F.col("resource_id").isNotNull()), missing
