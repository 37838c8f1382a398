"""Benchmark passages inside long texts: containment search on min-hash samples.

An item's sketch is the sample of its shingles with the smallest hashes. The share of
the sample that a text contains estimates how much of the item it contains, whatever the
text's length, so short items are found in long texts where similarity would vanish.
Items are partitioned by size: each partition has its own sample size and number of hits
that makes a candidate, and is searched only by texts long enough for it. Candidates are
verified on all shingles of the item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionlake.llm.stage import fresh, new_folder, staged
from mentionlake.operators.sizing import broadcast_if_small

SHINGLE = 5
CONTAINMENT = 0.8
#: Sample size of an item of n shingles: all up to 8, then 8 more for each doubling.
#: A candidate needs a quarter of the sample. An item contained by 0.8 or more misses
#: that with probability below 0.0002.
LEAST_SAMPLE = 8


def _words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    parts = F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda w: w != "")


def _shingled(rows: DataFrame, keys: list[str], short: tuple[int, ...] = ()) -> DataFrame:
    """``keys, n, shingles``: runs of five words, or all words of an item that has fewer,
    as hashes in text order. A text also gives its runs of each size in ``short``."""

    def runs(w: Column, k: Column | int) -> Column:
        last = F.greatest(F.size(w) - k + 1, F.lit(1))
        return F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(w, i, k)))

    def hashes(w: Column) -> Column:
        none = F.array().cast("array<bigint>")
        parts = [F.when(F.size(w) >= k, runs(w, k)).otherwise(none) for k in (SHINGLE, *short)]
        return F.concat(*parts) if len(parts) > 1 else parts[0]

    found = F.element_at(F.transform(F.array(_words(F.col("text"))), hashes), 1)
    rows = rows.select(*keys, F.explode(F.array(found)).alias("shingles"))
    return rows.select(*keys, F.size("shingles").alias("n"), "shingles").where("n > 0")


def _keyed(docs: DataFrame) -> DataFrame:
    """``id, row, text``: a key without nulls for each id and text; the last bit of ``row``
    says whether there is an id."""
    row = F.shiftleft(F.xxhash64(F.col("text").cast("string")), 1).bitwiseOR(F.col("doc_id").isNotNull().cast("bigint"))
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("id"), row.alias("row"), F.col("text").cast("string").alias("text"))


def _leaks(docs: DataFrame, benchmark: DataFrame, folder: str) -> DataFrame:
    """``id, row, item_id, n_shingles, n_shared``, see ``leaks``."""
    keys = ["id", "row"]
    n = F.size("words")
    given = benchmark.where("item_id is not null").select("item_id", "text", F.explode(F.array(_words(F.col("text")))).alias("words"))
    sizes = given.where((n > 0) & (n < SHINGLE)).select(n.alias("k")).distinct().collect()
    short = tuple(sorted(r["k"] for r in sizes))
    items = _shingled(given.where(n >= SHINGLE).select("item_id", "text"), ["item_id"])
    if short:
        whole = given.where((n > 0) & (n < SHINGLE)).select("item_id", n.alias("n"), F.array(F.xxhash64("words")).alias("shingles"))
        items = items.union(whole)
    items = items.groupBy("item_id").agg(F.array_distinct(F.flatten(F.collect_list("shingles"))).alias("shingles"))
    size = F.size("shingles")
    sample = F.least(size, F.lit(LEAST_SAMPLE) * F.greatest(F.lit(1), F.floor(F.log2(size)) - 2))
    items = staged(items.select(
        "item_id", size.alias("n_shingles"), "shingles",
        F.slice(F.sort_array("shingles"), 1, sample.cast("int")).alias("sample"),
        F.ceil(sample / 4).cast("int").alias("hits"),
        F.ceil(CONTAINMENT * size).cast("int").alias("least"),
    ), folder, "items")
    sketches = items.select("item_id", "hits", "least", F.explode("sample").alias("h"))
    found = (
        _shingled(docs, keys, short)
        .select(*keys, "n", F.explode("shingles").alias("h"))
        .join(broadcast_if_small(sketches), "h").where("n >= least")
        .groupBy(*keys, "item_id", "hits").agg(F.count_distinct("h").alias("met"))
    )
    found = staged(found.where("met >= hits").select(*keys, "item_id"), folder, "candidates")
    ids = broadcast_if_small(staged(found.select(*keys).distinct(), folder, "ids"))
    whole = items.select("item_id", "n_shingles", F.explode("shingles").alias("h"))
    shared = (
        _shingled(docs.join(ids, keys, "left_semi"), keys, short)
        .select(*keys, F.explode("shingles").alias("h"))
        .join(broadcast_if_small(whole), "h")
        .groupBy(*keys, "item_id", "n_shingles").agg(F.count_distinct("h").alias("n_shared"))
        .join(found, [*keys, "item_id"], "left_semi")
    )
    return shared.where(F.col("n_shared") >= F.ceil(F.lit(CONTAINMENT) * F.col("n_shingles")))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, n_shingles, n_shared, containment`` for every text that holds
    0.8 or more of an item's distinct five-word shingles.

    Words are lower-cased runs of letters and digits. An item of fewer than five words is
    one shingle of its own length, searched among the texts' runs of that length. Null and
    empty texts and items never match. Rows without an id are reported with a null one,
    items without one are not searched. Rows that repeat an id and a text count as one;
    each text of a repeated id is judged by itself. Repeated items count as one item with
    the shingles of all.
    """
    found = _leaks(_keyed(docs), benchmark, new_folder(docs.sparkSession, "leaks"))
    return found.select(
        F.when(F.col("row").bitwiseAND(1) == 1, F.col("id")).alias("doc_id"), "item_id",
        F.col("n_shingles").cast("bigint").alias("n_shingles"), "n_shared", (F.col("n_shared") / F.col("n_shingles")).alias("containment"),
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item, whatever their id."""
    folder = new_folder(docs.sparkSession, "leaks")
    hit = staged(_leaks(_keyed(docs), benchmark, folder).select("id", "row").distinct(), folder, "hit")
    key = {c: fresh(docs, f"leak_{c}") for c in ("id", "row")}
    text = F.col("text").cast("string")
    row = F.shiftleft(F.xxhash64(text), 1).bitwiseOR(F.col("doc_id").isNotNull().cast("bigint"))
    rows = docs.withColumns({key["id"]: F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)), key["row"]: row})
    return rows.join(broadcast_if_small(hit.withColumnsRenamed(key)), list(key.values()), "left_anti").select(*docs.columns)
