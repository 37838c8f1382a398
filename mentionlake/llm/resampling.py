"""Importance resampling towards a target: hashed n-gram gains, Gumbel keys, exact ranks."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mentionlake.llm.hashing import pieces
from mentionlake.llm.ngram_table import Grams
from mentionlake.llm.stage import fresh, new_folder, staged

BUCKETS = 10_000
LONGEST = 1
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
#: Rows that one task ranks; their number of tasks follows from it.
RANKED_ROWS = 1_000_000


def _counted(batches: Iterator[pa.RecordBatch], buckets: int, longest: int) -> Iterator[pa.RecordBatch]:
    """``bucket, n`` of everything the task reads, one row per bucket met."""
    total = np.zeros(buckets, dtype=np.int64)
    for batch in batches:
        for piece in pieces(batch):
            total += Grams(piece.column("text"), buckets, longest).bucket_counts(buckets)
    met = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """Features of all ``texts`` (column ``text``) by bucket. The driver gets one sum for
    each bucket, never anything that grows with the texts."""
    rows = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(
        partial(_counted, buckets=buckets, longest=longest), "bucket bigint, n bigint"
    )
    table = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(buckets, dtype=np.int64)
    counts[table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """By bucket, a thousand times the log of target over source probability, with one
    added to each bucket, rounded down."""
    buckets = len(source)
    s_all, t_all = float(source.sum() + buckets), float(target.sum() + buckets)
    pairs = zip(source.tolist(), target.tolist(), strict=True)
    return np.array([math.floor(1000 * math.log((float(t + 1) * s_all) / (float(s + 1) * t_all))) for s, t in pairs], dtype=np.int64)


def _weighed(batches: Iterator[pa.RecordBatch], gain: np.ndarray, longest: int, text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, text):
            grams = Grams(piece.column(text), len(gain), longest)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(grams.n_words, pa.int64()), pa.array(np.diff(grams.rows), pa.int64()), pa.array(grams.sums(gain), pa.int64())],
                names=["row", "n_words", "n_features", "weight"],
            )


def _scored(docs: DataFrame, target: DataFrame, buckets: int, longest: int, seed: int, carried: list[str]) -> DataFrame:
    """``row`` (the id and ``carried``), ``n_words, n_features, weight, score``."""
    gain = gains(bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest))
    row = [F.col("doc_id").cast("bigint").alias("doc_id"), *([F.struct(*carried).alias("all")] if carried else [])]
    rows = docs.select(F.struct(*row).alias("row"), F.col("text").cast("string").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    rows = rows.mapInArrow(
        partial(_weighed, gain=gain, longest=longest, text="text"),
        f"row {kind}, n_words bigint, n_features bigint, weight bigint",
    )
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("row.doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    key = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    return rows.withColumn("score", F.col("weight") + key)


def _ranked(rows: DataFrame, folder: str, min_words: int, percent: int) -> DataFrame:
    """``rows`` (staged) with ``rank``: 1, 2, 3... by falling score for the drawn ones, else null.

    Rows are cut into ranges of (score, id) and sorted inside them; a range's rank starts
    where the ranges before it end, so no task sees more than its range. A running number
    breaks ties between rows that repeat an id, however many there are.
    """
    able = rows.where(F.col("n_words") >= min_words)
    n = able.count()
    drawn = percent * n // 100
    spread = max(able.sparkSession.sparkContext.defaultParallelism, n // RANKED_ROWS + 1)
    order = [F.desc("score"), F.asc_nulls_first("row.doc_id"), F.asc("tie")]
    able = able.withColumn("tie", F.monotonically_increasing_id())
    able = able.repartitionByRange(spread, *order).sortWithinPartitions(*order).drop("tie")
    part, place = F.spark_partition_id(), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    able = staged(able.withColumn("part", part).withColumn("place", place), folder, "ranges")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = able.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    # One row per range, so it may be broadcast.
    able = able.join(F.broadcast(starts), "part").withColumn("rank", F.col("start") + F.col("place") + 1)
    able = able.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).drop("part", "place", "start")
    few = rows.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("bigint"))
    return able.unionByName(few)


def resampled(
    docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST,
    min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every row of ``docs``
    (``doc_id``, ``text``), drawn towards the texts of ``target`` (``text``).

    Features are the 1- to ``longest``-grams of a text's words, hashed into ``buckets``
    by crc32. A document's weight sums its features' gains; with a Gumbel number from
    its id added it becomes the score. Of the rows with ``min_words`` words, the
    ``percent`` % with the highest score are drawn without replacement and ranked.

    Null and empty texts have no features, weight 0 and are never drawn. A null id counts
    as an empty one for the Gumbel number and comes first among equal scores; rows that
    repeat an id share their Gumbel number and are drawn one by one, in any order where
    weights are equal too. Equal scores go by id. An empty ``docs`` gives no rows, an
    empty ``target`` leaves the gains to the smoothing. Other columns are not read.
    """
    folder = new_folder(docs.sparkSession, "resampling")
    rows = staged(_scored(docs, target, buckets, longest, seed, []), folder, "scores")
    ranked = _ranked(rows, folder, min_words, percent)
    return ranked.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_features", "weight", "score", "rank")


def draw(
    docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST,
    min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns and their rank as ``draw_rank``
    (with underscores before it where ``docs`` has such a column). See ``resampled``."""
    folder = new_folder(docs.sparkSession, "draw")
    rows = staged(_scored(docs, target, buckets, longest, seed, docs.columns), folder, "scores")
    drawn = _ranked(rows, folder, min_words, percent).where(F.col("rank").isNotNull())
    return drawn.select("row.all.*", F.col("rank").alias(fresh(docs, "draw_rank")))
