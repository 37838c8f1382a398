"""The incremental forms of the batch jobs, as Structured Streaming queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mentionlake.operators.detect import find_in_texts
from mentionlake.operators.rollup import merge_counts, prediction_counts, specificity
from mentionlake.operators.score import score_mentions
from mentionlake.sources.fact_store import BUCKETS, commit_facts
from mentionlake.sources.writers import append_facts


def first_seen_stream(
    records: DataFrame, delay: str = "365 days", salts: int = 32, spread_by: str = "event_id"
) -> DataFrame:
    """First record per article among records no more than ``delay`` apart.

    State is dropped once the watermark passes, so a repeat that arrives later counts as
    new; the batch job has no such limit. Two stages: repeats are first dropped inside
    salted slices, then across them, so a very common id is not one task's work.
    """
    salt = F.pmod(F.xxhash64(spread_by), F.lit(salts))
    sliced = records.withColumn("_salt", salt).withWatermark("seen_at", delay)
    thinned = sliced.dropDuplicatesWithinWatermark(["pmcid", "_salt"])
    return thinned.drop("_salt").dropDuplicatesWithinWatermark(["pmcid"])


def first_record_stream(records: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """The first record of each article over the whole stream: ``records`` with ``pmcid, seen_at,
    event_id`` and others, by time and then by event.

    One stateful operator keeps the earliest record of each article, one row of state; a batch
    is reduced in its tasks before it meets the state, so a common id sends a row per task. A
    batch writes the articles whose first record it changed or confirmed, and replaces its own
    folder when it runs again; :func:`first_records` reads the latest. However late or often a
    record comes, the end is that of the batch job. Rows without ``pmcid`` are left out.
    """
    rest = [c for c in records.columns if c not in ("pmcid", "seen_at", "event_id")]
    first = F.min(F.struct("seen_at", "event_id", *rest)).alias("first")
    state = records.where("pmcid is not null and seen_at is not null").groupBy("pmcid").agg(first)

    def work(batch: DataFrame, batch_id: int) -> None:
        batch.select("pmcid", "first.*").write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        state.writeStream.outputMode("update").foreachBatch(work)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def first_records(spark: SparkSession, path: str) -> DataFrame:
    """The first record of each article as of the last batch."""
    rows = spark.read.parquet(path)
    rest = [c for c in rows.columns if c not in ("pmcid", "batch")]
    return rows.groupBy("pmcid").agg(F.min(F.struct(*rest)).alias("first")).select("pmcid", "first.*")


def write_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def _per_batch(stream: DataFrame, checkpoint: str, work) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(work)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def mentions_stream(
    texts: DataFrame, aliases: DataFrame, case_sensitive: Sequence[str], path: str, checkpoint: str
) -> StreamingQuery:
    """Mentions of arriving texts. Every rule looks at one article only, so a batch needs
    no state; a batch run again replaces its own folder."""

    def work(batch: DataFrame, batch_id: int) -> None:
        found = find_in_texts(batch, aliases, case_sensitive)
        found.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return _per_batch(texts, checkpoint, work)


def counts_stream(
    texts: DataFrame,
    aliases: DataFrame,
    case_sensitive: Sequence[str],
    weights: DataFrame,
    path: str,
    checkpoint: str,
) -> StreamingQuery:
    """Prediction counts per batch, kept as partial counts for :func:`current_counts`.
    ``weights`` is read by every batch: pass a stored table."""

    def work(batch: DataFrame, batch_id: int) -> None:
        scored = score_mentions(find_in_texts(batch, aliases, case_sensitive), weights)
        prediction_counts(scored).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return _per_batch(texts, checkpoint, work)


def current_counts(spark: SparkSession, path: str) -> DataFrame:
    return merge_counts(spark.read.parquet(path))


def current_specificity(spark: SparkSession, path: str) -> DataFrame:
    return specificity(current_counts(spark, path))


def running_counts(scored: DataFrame) -> DataFrame:
    """Counts over a stream of scored mentions, for complete or update mode; partial
    sums are formed before the state is touched."""
    return scored.groupBy("resource_name", "alias", "prediction").agg(F.count("*").alias("n"))


def facts_stream(facts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append facts batch by batch; stored keys are skipped, so a replay adds nothing."""

    def work(batch: DataFrame, batch_id: int) -> None:
        append_facts(batch, path)

    return _per_batch(facts, checkpoint, work)


def fact_store_stream(
    facts: DataFrame, path: str, checkpoint: str, publications: DataFrame | None = None,
    buckets: int = BUCKETS, name: str = "facts",
) -> StreamingQuery:
    """Commits facts batch by batch to the store of :mod:`~mentionlake.sources.fact_store`,
    under ``name`` and the batch number. A replayed batch is known by its id; a stream that
    starts over under another name finds its keys stored. Each batch is stored once
    before it is used, as a commit reads it several times."""

    def work(batch: DataFrame, batch_id: int) -> None:
        held = f"{path}/incoming/{name}-{batch_id}"
        batch.write.mode("overwrite").parquet(held)
        rows = batch.sparkSession.read.schema(batch.schema).parquet(held)
        commit_facts(rows, path, f"{name}-{batch_id}", publications, buckets)

    return _per_batch(facts, checkpoint, work)


def specificity_stream(scored: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Positive and negative counts of each alias over a stream of scored mentions, kept in
    the state store. A batch writes the aliases it changed, with their totals so far; one
    that runs again replaces its own folder."""
    keyed = scored.dropna(subset=["resource_name", "alias", "prediction"])
    counts = keyed.groupBy("resource_name", "alias").agg(
        F.count_if(F.col("prediction") == 0).alias("negatives"), F.count_if(F.col("prediction") == 1).alias("positives")
    )

    def work(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        counts.writeStream.outputMode("update").foreachBatch(work)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def streamed_specificity(spark: SparkSession, path: str) -> DataFrame:
    """The specificity of each alias by its latest totals."""
    rows = spark.read.parquet(path)
    last = rows.groupBy("resource_name", "alias").agg(F.max_by(F.struct("negatives", "positives"), "batch").alias("n"))
    totals = last.select("resource_name", "alias", "n.negatives", "n.positives")
    share = F.col("positives") / (F.col("negatives") + F.col("positives"))
    return totals.withColumn("specificity", F.round(share, 6))
