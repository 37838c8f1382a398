"""Size checks that decide between a broadcast and a shuffled join."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ROWS = 1_000_000
MAX_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int
    fits: bool
    marked: int
    most: int


def row_bytes(df: DataFrame) -> Column:
    """Size of a row: its text, and 16 bytes for each value of another type."""
    width = F.lit(0).cast("bigint")
    for name, kind in df.dtypes:
        if kind == "string":
            width = width + F.coalesce(F.octet_length(F.col(name)), F.lit(0))
        elif kind == "array<string>":
            width = width + F.coalesce(F.octet_length(F.array_join(name, ",")), F.lit(0))
        elif kind.startswith(("array", "map", "struct")):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(name))), F.lit(0))
        else:
            width = width + F.lit(16)
    return width


def measure(
    df: DataFrame,
    max_rows: int = MAX_ROWS,
    max_bytes: int = MAX_BYTES,
    mark: Column | None = None,
    copies: str | None = None,
    more: str | None = None,
) -> Size:
    """Row count and text size of ``df``, how many rows meet ``mark``, and the most ``copies``.
    A row may stand for several, whose number is in the column ``copies`` and whose other
    columns take ``more`` bytes in all."""
    times = F.lit(1) if copies is None else F.col(copies)
    width = row_bytes(df.drop(*filter(None, (copies, more)))) * times + (F.lit(0) if more is None else F.col(more))
    row = df.agg(
        F.coalesce(F.sum(times), F.lit(0)).alias("n"),
        F.coalesce(F.sum(width), F.lit(0)).alias("b"),
        F.count_if(F.lit(False) if mark is None else mark).alias("m"),
        F.coalesce(F.max(times), F.lit(0)).alias("most"),
    ).first()
    fits = row["n"] <= max_rows and row["b"] <= max_bytes
    return Size(row["n"], row["b"], fits, row["m"], row["most"])


def broadcast_if_small(
    df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES
) -> DataFrame:
    """Hint a broadcast only after the size was checked; beyond it the join shuffles
    and adaptive execution splits skewed partitions."""
    return F.broadcast(df) if measure(df, max_rows, max_bytes).fits else df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use all cores on an input with fewer partitions than cores; a large input has
    more and is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df
