"""Mixing sources to target weights along a curriculum.

Each source has a weight that changes over training time. Its integral is the source's
cumulative demand for words; inverting it at the words handed out before a document
gives the document's training position in [0, 1]. Documents are range-sorted by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mentionlake.llm.quality import word_array
from mentionlake.llm.stage import fresh

#: Weights of the sources in order, repeating, and their course from start to end of
#: training as factors of the mean weight.
WEIGHTS = (3, 1, 2)
RAMPS = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
BUDGET = 1.5
MOST_REPEATS = 2
#: Hexadecimal digits of the hash that cut a source into slices for running sums.
SLICE_DIGITS = 3


def targets(sizes: DataFrame) -> DataFrame:
    """``key, source_size, place, target`` from ``key, source, source_size``: one row per source.

    The target is the weight's share of the budget, but at most twice the source's size;
    what is above is shared again by weight. With sources in order of size over weight,
    the full ones are a prefix, found from running sums over the sources alone.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    rows = sizes.withColumn("place", place)
    rows = rows.withColumn("weight", F.get(F.array(*map(F.lit, WEIGHTS)), F.pmod("place", F.lit(len(WEIGHTS)))))
    rows = rows.withColumn("cap", MOST_REPEATS * F.col("source_size"))
    every = Window.partitionBy()
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before, after = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    rows = rows.withColumn("level", (
        BUDGET * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    ) / F.sum("weight").over(after))
    open_ = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct("place", "level"))
    first = F.first(open_, ignorenulls=True).over(fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = rows.withColumn("final", first["level"])
    share = F.coalesce(F.least(F.col("cap").cast("double"), F.col("final") * F.col("weight")), F.col("cap").cast("double"))
    return rows.select("key", "source_size", "place", share.alias("target"))


def position(place: Column, part: Column) -> Column:
    """Training time at which a source has handed out ``part`` of its target: the inverse
    of the integral of its ramp."""
    a = F.get(F.array(*(F.lit(float(r[0])) for r in RAMPS)), F.pmod(place, F.lit(len(RAMPS))))
    b = F.get(F.array(*(F.lit(float(r[1])) for r in RAMPS)), F.pmod(place, F.lit(len(RAMPS))))
    root = (F.sqrt(a * a + (b - a) * (a + b) * part) - a) / (b - a)
    return F.when(a == b, part).otherwise(root)


def planned(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a struct column ``name``: ``size``, ``source_size``, ``target``,
    ``passes`` (times the mix takes the document), ``place`` of the source and ``start``,
    the words of the source before it.

    A source's documents follow a hash of their id, those without one a hash of their text. It is passed through as often as the
    target allows; of a last, partial pass, the documents whose middle lies before its end
    are taken, so the words come within half a document of the target. Documents without
    words (null, empty) are taken no time. Rows that repeat an id are documents of their
    own. Running sums go by slice of a source, so no source is summed in one task.
    """
    size, key, digest, slice_, start, source_of = (fresh(docs, f"{name}_{x}") for x in ("size", "key", "digest", "slice", "start", "source"))
    source = F.col("source").cast("string")
    rows = docs.withColumns({
        size: F.size(word_array(F.col("text"))).cast("bigint"),
        key: F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source)),
        digest: F.md5(F.coalesce(F.col("doc_id").cast("string"), F.col("text").cast("string"), F.lit("")).cast("binary")),
    })
    rows = rows.withColumn(slice_, F.substring(digest, 1, SLICE_DIGITS))
    small = rows.select(F.col(key).alias("key"), F.col(slice_).alias("slice"), F.col(size).alias("size"))
    slices = small.groupBy("key", "slice").agg(F.sum("size").alias("words"))
    sizes = slices.groupBy("key").agg(F.sum("words").alias("source_size"))
    sizes = sizes.withColumn("source", F.when(F.col("key") == "n", F.lit(None).cast("string")).otherwise(F.substr("key", F.lit(2))))
    earlier = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    slices = slices.join(targets(sizes), "key").select(
        F.col("key").alias(key), F.col("slice").alias(slice_),
        F.struct("before", "source_size", "target", "place").alias(source_of),
    )
    inside = Window.partitionBy(key, slice_).orderBy(digest, size).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn(start, F.coalesce(F.sum(size).over(inside), F.lit(0))).join(slices, [key, slice_])
    given = F.col(source_of)
    begin = F.col(start) + given["before"]
    whole = F.floor(given["target"] / F.greatest(given["source_size"], F.lit(1)))
    rest = given["target"] - whole * given["source_size"]
    passes = whole + F.when(begin + F.col(size) / 2 <= rest, 1).otherwise(0)
    passes = F.when(F.col(size) > 0, F.least(passes, F.lit(MOST_REPEATS))).otherwise(0)
    return rows.select(*docs.columns, F.struct(
        F.col(size).alias("size"), given["source_size"].alias("source_size"), given["target"].alias("target"),
        passes.cast("bigint").alias("passes"), given["place"].alias("place"), begin.alias("start"),
    ).alias(name))


def _at(name: str, repeat: Column) -> Column:
    m = F.col(name)
    part = (m["start"] + repeat * m["source_size"]) / F.greatest(m["target"], F.lit(1.0))
    return position(m["place"], F.least(part, F.lit(1.0)))


def mix(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for every time the mix takes it, range-sorted by training
    position; the columns are those of ``docs``."""
    name = fresh(docs, "mix")
    rows = planned(docs, name)
    again = fresh(docs, "mix_pass")
    rows = rows.where(F.col(name)["passes"] > 0)
    rows = rows.withColumn(again, F.explode(F.sequence(F.lit(0), F.col(name)["passes"] - 1)))
    return rows.orderBy(_at(name, F.col(again)), F.xxhash64("doc_id")).select(*docs.columns)


def mixed_plan(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken, position`` for every row, range-sorted
    by the position of its first pass (documents that are not taken have none)."""
    rows = planned(docs.select("doc_id", "text", "source"), "mix")
    m = F.col("mix")
    first = F.when(m["passes"] > 0, F.round(_at("mix", F.lit(0)), 9))
    return rows.select(
        "doc_id", m["size"].alias("size"), m["source_size"].alias("source_size"), m["target"].alias("target"),
        (m["passes"] * m["size"]).alias("taken"), first.alias("position"),
    ).orderBy("position", "doc_id")
