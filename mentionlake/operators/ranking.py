"""Ranking and top-n without sending one big group to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LEVEL_BITS = 16
# Up to this n Spark itself trims each map task's groups before the shuffle.
GROUP_LIMIT = 1000


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``. The rank filter is applied before the
    shuffle as well, so a hot key sends one row per map task."""
    return top_n_per_key(df, keys, order, 1).drop("rank_in_key")


def top_n_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, salts: int = 64
) -> DataFrame:
    """The first ``n`` rows of each key with their rank, exactly ``n`` where available."""
    rows = df
    if n > GROUP_LIMIT:
        # Beyond the built-in trim: rank inside salted slices first, then across them.
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salts))
        rows = rows.withColumn("_salt", salt)
        sliced = Window.partitionBy(*keys, "_salt").orderBy(*order)
        rows = rows.withColumn("_r", F.row_number().over(sliced)).where(F.col("_r") <= n)
        rows = rows.drop("_salt", "_r")
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("rank_in_key", F.row_number().over(w)).where(
        F.col("rank_in_key") <= n
    )


def _running_offset(counts: DataFrame, child: str, parent: str | None, out: str) -> DataFrame:
    """Rows that come before each child inside its parent."""
    w = Window.partitionBy(parent) if parent else Window.partitionBy()
    w = w.orderBy(child).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(out, F.coalesce(F.sum("_n").over(w), F.lit(0)))


def global_rank(df: DataFrame, key: str, out: str = "rank", tie: str | None = None) -> DataFrame:
    """0-based rank over the whole frame by a bigint key without nulls; rows of equal key
    follow ``tie``.

    Keys fall into buckets of 2^16 values; buckets, bucket groups and groups of
    groups each rank inside windows of at most 2^16 rows, so nothing is sorted in
    one place whatever the number of rows. Only the top level, at most 2^16 rows
    for any bigint, is ranked as a whole.
    """
    b = LEVEL_BITS
    rows = df.withColumn("_b1", F.shiftright(F.col(key), b))
    c1 = rows.groupBy("_b1").agg(F.count("*").alias("_n"))
    c1 = c1.withColumn("_b2", F.shiftright(F.col("_b1"), b))
    c2 = c1.groupBy("_b2").agg(F.sum("_n").alias("_n"))
    c2 = c2.withColumn("_b3", F.shiftright(F.col("_b2"), b))
    c3 = c2.groupBy("_b3").agg(F.sum("_n").alias("_n"))
    o3 = _running_offset(c3, "_b3", None, "_o3").select("_b3", "_o3")
    o2 = _running_offset(c2, "_b2", "_b3", "_o2").join(o3, "_b3").select(
        "_b2", (F.col("_o2") + F.col("_o3")).alias("_o2")
    )
    o1 = _running_offset(c1, "_b1", "_b2", "_o1").join(o2, "_b2").select(
        "_b1", (F.col("_o1") + F.col("_o2")).alias("_o1")
    )
    inner = F.row_number().over(Window.partitionBy("_b1").orderBy(key, *([tie] if tie else []))) - 1
    return (
        rows.withColumn("_r", inner)
        .join(o1, "_b1")
        .withColumn(out, (F.col("_o1") + F.col("_r")).cast("bigint"))
        .drop("_b1", "_r", "_o1")
    )


def below_nth(df: DataFrame, h: str, key: str, n: int, buckets_of: int) -> Column:
    """True for the ``n`` rows that come first by (``h``, ``key``), ``key`` unique.

    ``h`` is a hash in [0, 2^32). Counts per hash bucket (a fixed number of buckets)
    locate the one bucket that holds the n-th row; only that bucket is ranked. The
    rows themselves are neither shuffled nor sorted: the cut is a scalar.
    """
    bucket = F.floor(F.col(h) / F.lit(2**32 // buckets_of)).cast("bigint")
    if n <= 0:
        return F.lit(False)
    rows = df.select(F.col(h).alias("_h"), F.col(key).alias("_k"), bucket.alias("_b1"))
    counts = rows.groupBy("_b1").agg(F.count("*").alias("_n"))
    offs = _running_offset(counts, "_b1", None, "_o")
    hit = offs.where((F.col("_o") < n) & (F.col("_o") + F.col("_n") >= n))
    w = Window.partitionBy("_b1").orderBy("_h", "_k")
    cut = (
        rows.join(F.broadcast(hit.select("_b1", "_o")), "_b1")
        .withColumn("_r", F.row_number().over(w) + F.col("_o"))
        .where(F.col("_r") == n)
        .select(F.struct("_h", "_k").alias("cut"))
    )
    here = F.struct(F.col(h).alias("_h"), F.col(key).alias("_k"))
    return F.coalesce(here <= cut.scalar(), F.lit(True))
