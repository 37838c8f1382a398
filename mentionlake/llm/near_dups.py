"""Near-duplicate classes by Order MinHash, verified by banded alignment.

A text is a sequence of five-word shingles. Equal shingles are told apart by an
occurrence number, so each text is a set of labelled k-mers. A sketch entry takes the
``WIDTH`` labelled k-mers with the smallest hashes and keeps them in text order: two
texts agree on an entry only if they share these k-mers in the same order, which makes
the sketch follow edit similarity instead of bare overlap. Every entry is a bucket key.

Similarity is that of an alignment of the two shingle sequences: with ``c`` aligned
shingles it is ``c / (n1 + n2 - c)``, and texts are near copies from 0.8 on. Such an
alignment never leaves a band of ``(n1 + n2) / 9`` around the diagonal, so the banded
alignment is exact for every pair that counts.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mentionlake.llm.components import components
from mentionlake.llm.hashing import mix, pieces, shingles, word_hashes
from mentionlake.llm.stage import fresh, new_folder, staged

SHINGLE = 5
SIMILARITY = 0.8
ENTRIES = 32
#: Shapes of sketch entries: for texts of so many k-mers, the k-mers an entry takes. Near
#: copies differ in length by a factor of 0.8 at most, so neighbouring shapes overlap by
#: more than that.
SHAPES = ((1, 9, 1), (7, 31, 3), (24, None, 7))
#: A late round has so many times the leads of the one before; rounds go on to the end.
GROWTH = 4
#: Longs of a text's parity bitmap.
PARITY = 8
#: Slots of k-mer counts. They only order a text's k-mers: no result depends on them.
SLOT_BITS = 20
_SKETCH = "doc_id bigint, n_words bigint, copy_a bigint, copy_b bigint, keys array<bigint>"
_seed = np.random.default_rng(20240229)
_XOR = _seed.integers(0, 2**64, size=ENTRIES, dtype=np.uint64)
_ODD = _seed.integers(0, 2**64, size=ENTRIES, dtype=np.uint64) | np.uint64(1)


def sequence(words: np.ndarray) -> np.ndarray:
    """The shingles of a text; a text of fewer than five words is one shingle."""
    return shingles(words, min(SHINGLE, max(1, len(words))))


def labelled(kmers: np.ndarray) -> np.ndarray:
    """K-mers with their occurrence number hashed in."""
    order = np.argsort(kmers, kind="stable")
    ranked = kmers[order]
    same = np.flatnonzero(ranked[1:] == ranked[:-1]) + 1
    if not len(same):
        return kmers
    starts = np.ones(len(kmers), dtype=bool)
    starts[same] = False
    index = np.arange(len(kmers))
    run = np.maximum.accumulate(np.where(starts, index, 0))
    number = np.empty(len(kmers), dtype=np.uint64)
    number[order] = (index - run).astype(np.uint64)
    return np.where(number > 0, mix(kmers + number * np.uint64(0x9E3779B97F4A7C15)), kmers)


def _ordered(items: np.ndarray, width: int) -> np.ndarray:
    """One key per entry: its ``width`` smallest k-mers, hashed in text order."""
    n = len(items)
    width = min(width, n)
    rows = max(1, min(ENTRIES, 500_000 // n))
    least = np.empty((ENTRIES, width), dtype=np.uint64)
    for j in range(0, ENTRIES, rows):
        hashes = items ^ _XOR[j : j + rows, None]
        hashes *= _ODD[j : j + rows, None]
        if width < n:
            at = np.argpartition(hashes, width, axis=1)[:, :width]
            at.sort(axis=1)
            hashes = np.take_along_axis(hashes, at, axis=1)
        least[j : j + rows] = hashes
    key = np.arange(width * 1000, width * 1000 + ENTRIES, dtype=np.uint64)
    for x in least.T:
        key = (key ^ x) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return mix(key)


def bucket_keys(kmers: np.ndarray) -> np.ndarray:
    """The sketch entries of one text as bucket keys."""
    items = labelled(kmers)
    n = len(items)
    shapes = [s for s in SHAPES if n >= s[0] and (s[1] is None or n <= s[1])]
    return np.concatenate([_ordered(items, s[2]) for s in shapes])


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            for piece in pieces(batch):
                words, offsets = word_hashes(piece.column("text"))
                n = np.diff(offsets)
                keys, copy = [], np.zeros((2, len(n)), dtype=np.uint64)
                for i in range(len(n)):
                    own = words[offsets[i] : offsets[i + 1]]
                    if len(own):
                        place = np.arange(1, len(own) + 1, dtype=np.uint64)
                        copy[0, i] = mix(own + place * np.uint64(0xA0761D6478BD642F)).sum()
                        copy[1, i] = mix(own * np.uint64(0xE7037ED1A0B428DB) ^ place).sum()
                    keys.append(_signed(bucket_keys(sequence(own))) if len(own) else np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"), pa.array(n.astype(np.int64)),
                        pa.array(_signed(copy[0])), pa.array(_signed(copy[1])),
                        pa.array(keys, type=pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_words", "copy_a", "copy_b", "keys"],
                )


def _slots(kmers: np.ndarray) -> np.ndarray:
    return (kmers >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def rarest(kmers: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The labelled k-mers of one text that a near copy cannot miss all of: the first in an
    order that all texts share, rare ones first, one more than the fifth a copy may lack."""
    items = labelled(kmers)
    n = len(items)
    keep = n - int(np.ceil(SIMILARITY * n - 1e-9)) + 1
    return items[np.lexsort((items, levels[_slots(items)]))[:keep]]


def parity(kmers: np.ndarray) -> np.ndarray:
    """The labelled k-mers of one text as a bitmap: a bit is set if an odd number of them
    falls on it. Two bitmaps differ in no more bits than k-mers that only one text has."""
    bits = mix(labelled(kmers) + np.uint64(0xD6E8FEB86659FD93)) & np.uint64(64 * PARITY - 1)
    odd = np.bincount(bits.astype(np.int64), minlength=64 * PARITY) % 2
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``slot, n``: how many labelled k-mers of a piece fall into a slot."""
    with np.errstate(over="ignore"):
        for batch in batches:
            for piece in pieces(batch):
                words, offsets = word_hashes(piece.column("text"))
                spans = zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
                items = [labelled(sequence(words[a:b])) for a, b in spans if b > a]
                slot, n = np.unique(_slots(np.concatenate(items)) if items else np.zeros(0, np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int64()), pa.array(n, pa.int64())], names=["slot", "n"])


def _rare(batches: Iterator[pa.RecordBatch], levels: Broadcast) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            for piece in pieces(batch):
                words, offsets = word_hashes(piece.column("text"))
                kmers = [sequence(words[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                keys = [_signed(rarest(k, levels.value)) for k in kmers]
                bits = np.array([parity(k) for k in kmers], dtype=np.int64).reshape(-1, PARITY)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"), pa.array([len(k) for k in kmers], pa.int64()), pa.array(keys, type=pa.list_(pa.int64())),
                        *(pa.array(bits[:, i]) for i in range(PARITY)),
                    ],
                    names=["node", "size", "keys", *(f"p{i}" for i in range(PARITY))],
                )


class Aligner:
    """Longest common subsequence inside a band, a row of bits at a time."""

    def __init__(self, base: np.ndarray) -> None:
        self.n = len(base)
        self.masks: dict[int, int] = {}
        for i, s in enumerate(base.tolist()):
            self.masks[s] = self.masks.get(s, 0) | (1 << i)

    def similarity(self, other: np.ndarray) -> float:
        n, m = self.n, len(other)
        if not n or not m or min(n, m) < SIMILARITY * max(n, m):
            return 0.0
        known = [self.masks.get(s, 0) for s in other.tolist()]
        if sum(1 for k in known if k) < SIMILARITY * (n + m) / (1 + SIMILARITY) - 1e-9:
            return 0.0
        half = (n + m) // 9 + 1
        full = (1 << n) - 1
        window = (1 << (2 * half + 1)) - 1
        row = full
        for j, mask in enumerate(known):
            if mask:
                shift = j - half
                mask &= window << shift if shift >= 0 else window >> -shift
                hit = row & mask
                row = ((row + hit) | (row & ~mask)) & full
        aligned = n - row.bit_count()
        return aligned / (n + m - aligned)


def aligned_similarity(a: str, b: str) -> float:
    """Similarity of two texts, as the operator verifies it."""
    with np.errstate(over="ignore"):
        x, y = ([sequence(w)] if len(w) else [] for w, _ in (word_hashes(pa.array([t])) for t in (a, b)))
        return Aligner(x[0]).similarity(y[0]) if x and y else 0.0


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, aligner = None, None
    with np.errstate(over="ignore"):
        for batch in batches:
            a, b, ta, tb = (batch.column(c) for c in ("a", "b", "text_a", "text_b"))
            keep = []
            for i in range(batch.num_rows):
                lead = b[i].as_py()
                if aligner is None or lead != last:
                    words, _ = word_hashes(tb.slice(i, 1))
                    last, aligner = lead, Aligner(sequence(words))
                words, _ = word_hashes(ta.slice(i, 1))
                if aligner.similarity(sequence(words)) >= SIMILARITY:
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([a.take(pa.array(keep, pa.int64())), b.take(pa.array(keep, pa.int64()))], names=["a", "b"])


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose texts are near copies; a hot lead is split by adaptive execution."""
    rows = pairs.select("a", "b").join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
    return rows.sortWithinPartitions("b").mapInArrow(_verify, "a bigint, b bigint")


def near_classes(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id, n_words, first_copy`` for every row of ``docs`` (``doc_id``, ``text``).

    ``class_id`` is the smallest id of the texts that a chain of near copies connects;
    ``first_copy`` the smallest id with the same words. Texts without words (null, empty,
    only spaces) are nobody's copies: each is a class of its own, with its own id. Rows
    that repeat an id get one result each. A null id is never linked and stays null.

    Exact copies collapse before buckets are made. A bucket never yields all its pairs at
    first: its members are compared with one lead (of each text's leads the one met in most
    buckets first, the others only if that left them in different classes). Where a bucket
    of three or more then still holds two classes, all its members, those that met their
    lead included, are grouped anew by their rarest k-mers, an exact prefix filter: two
    texts at 0.8 or more always share one. There leads, those with most near copies first,
    are compared with all members, ever more leads a round, until each bucket is one class
    or all its pairs were compared; pairs whose lengths or parity bitmaps rule out 0.8 (an
    exact bound on the k-mers that only one of them has) never leave the join. There is no
    cap on buckets, members or rounds. Pairs at exactly 0.8 meet in a bucket with
    probability 0.9995, pairs at 0.85 or more with 0.99999; all that meet are found.
    """
    folder = new_folder(docs.sparkSession, "near-dups")
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = staged(source.mapInArrow(_sketches, _SKETCH), folder, "sketches")
    copies = (
        sketch.where("doc_id is not null and n_words > 0").groupBy("copy_a", "copy_b")
        .agg(F.min("doc_id").alias("node"), F.min_by("keys", "doc_id").alias("keys"))
    )
    copies = staged(copies, folder, "copies")
    buckets = staged(_led(copies.select("node", F.explode("keys").alias("key"))), folder, "buckets0")
    wanted = buckets.select("node").union(buckets.select("lead")).distinct()
    texts = staged(
        source.join(wanted.withColumnRenamed("node", "doc_id"), "doc_id").dropDuplicates(["doc_id"]), folder, "texts"
    )
    pairs = staged(
        buckets.groupBy(F.col("node").alias("a"), F.col("lead").alias("b")).agg(F.count("*").alias("n")), folder, "pairs0"
    )
    best = Window.partitionBy("a").orderBy(F.desc("n"), "b")
    first = pairs.withColumn("r", F.row_number().over(best)).where("r = 1")
    links = staged(_verified(first, texts), folder, "links0")
    roots = components(links, f"{folder}/roots0")
    left = staged(_apart(pairs.select("a", "b"), roots), folder, "left")
    if not left.isEmpty():
        links = links.union(staged(_verified(left, texts), folder, "links"))
        roots = components(links, f"{folder}/roots")
    crowded = staged(_crowded(buckets, roots), folder, "crowded")
    if not crowded.isEmpty():
        opened = staged(texts.join(crowded.withColumnRenamed("node", "doc_id"), "doc_id", "left_semi"), folder, "opened")
        roots = _exhausted(opened, links, roots, folder)
    named = copies.join(roots, "node", "left").select(
        "copy_a", "copy_b", F.col("node").alias("first_copy"), F.coalesce("root", "node").alias("class_id")
    )
    return sketch.join(
        named, (sketch.copy_a == named.copy_a) & (sketch.copy_b == named.copy_b) & (sketch.n_words > 0) & sketch.doc_id.isNotNull(), "left"
    ).select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), "n_words", F.coalesce("first_copy", "doc_id").alias("first_copy")
    )


def _led(rows: DataFrame) -> DataFrame:
    """``key, node, lead``: every other member of a bucket next to its first one, in an
    order that differs by bucket."""
    order = F.struct(F.xxhash64("node", "key").alias("h"), "node")
    lead = rows.groupBy("key").agg(F.count("*").alias("n"), F.min(order).alias("lead")).where("n > 1").drop("n")
    return rows.join(lead, "key").where(F.col("lead") < order).select("key", "node", F.col("lead.node").alias("lead"))


def _crowded(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """``node``: all members of the buckets with pairs never compared and two classes."""
    rows = buckets.join(roots.toDF("node", "_a"), "node", "left").join(roots.toDF("lead", "_b"), "lead", "left")
    apart = F.max(F.coalesce("_a", "node") != F.coalesce("_b", "lead"))
    keys = rows.groupBy("key").agg(F.count("*").alias("n"), apart.alias("apart")).where("n > 1 and apart").select("key")
    rows = buckets.join(keys, "key", "left_semi")
    return rows.select("node").union(rows.select("lead")).distinct()


def _levels(texts: DataFrame) -> np.ndarray:
    """How common the k-mers of each slot are, in eighths of a power of two."""
    table = texts.mapInArrow(_counted, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    levels = np.zeros(1 << SLOT_BITS, dtype=np.uint8)
    slot, n = (table.column(c).to_numpy() for c in ("slot", "n"))
    levels[slot] = np.minimum(255, np.round(8 * np.log2(np.maximum(n, 1))))
    return levels


def _exhausted(texts: DataFrame, links: DataFrame, roots: DataFrame, folder: str) -> DataFrame:
    """``roots`` after all pairs of ``texts`` that can be near copies are in one class or
    were compared."""
    spark = texts.sparkSession
    rows = texts.mapInArrow(
        partial(_rare, levels=spark.sparkContext.broadcast(_levels(texts))),
        "node bigint, size bigint, keys array<bigint>" + "".join(f", p{i} bigint" for i in range(PARITY)),
    )
    bitmap = [f"p{i}" for i in range(PARITY)]
    ends = links.where("a <> b").select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))
    members = rows.join(ends, "node", "left").select(
        F.explode("keys").alias("key"), "node", "size", F.coalesce("degree", F.lit(0)).alias("degree"), *bitmap
    )
    # The order of leads is one for all buckets, so a pair always has the same lead.
    order = F.struct((-F.col("degree")).alias("d"), F.xxhash64("node").alias("h"), "node")
    members = members.select("key", "size", order.alias("at"), *bitmap)
    seen, step, past, leads = None, 0, 0, 1
    while True:
        step += 1
        rows = members.join(roots.withColumnsRenamed({"node": "_n"}), F.col("at.node") == F.col("_n"), "left")
        rows = rows.select("key", "size", "at", F.coalesce("root", "at.node").alias("root"), *bitmap)
        several = rows.groupBy("key").agg(F.count("*").alias("n"), (F.min("root") != F.max("root")).alias("apart"))
        several = several.where((F.col("n") > past + 1) & F.col("apart")).select("key")
        rows = staged(rows.join(several, "key", "left_semi"), folder, f"members{step}")
        if rows.isEmpty():
            return roots
        members = rows.drop("root")
        rank = F.row_number().over(Window.partitionBy("key").orderBy("at"))
        first = rows.withColumn("r", rank).where(F.col("r") <= past + leads).where(F.col("r") > past)
        first = first.select(
            "key", F.col("at").alias("lead"), F.col("size").alias("lead_size"), F.col("root").alias("lead_root"),
            *(F.col(p).alias(f"lead_{p}") for p in bitmap),
        )
        pairs = rows.join(first, "key").where((F.col("lead") < F.col("at")) & (F.col("lead_root") != F.col("root")))
        pairs = pairs.where(F.least("size", "lead_size") >= SIMILARITY * F.greatest("size", "lead_size") - 1e-9)
        apart = functools.reduce(Column.__add__, (F.bit_count(F.col(p).bitwiseXOR(F.col(f"lead_{p}"))) for p in bitmap))
        pairs = pairs.where(apart <= (F.col("size") + F.col("lead_size")) * (1 - SIMILARITY) / (1 + SIMILARITY) + 1e-9)
        pairs = pairs.select(F.col("at.node").alias("a"), F.col("lead.node").alias("b")).distinct()
        if seen is not None:
            pairs = pairs.join(seen, ["a", "b"], "left_anti")
        pairs = staged(pairs, folder, f"pairs{step}")
        if not pairs.isEmpty():
            seen = pairs if seen is None else seen.union(pairs)
            found = staged(_verified(pairs, texts), folder, f"links{step}")
            if not found.isEmpty():
                links = links.union(found)
                roots = components(links, f"{folder}/roots{step}")
        past, leads = past + leads, leads * GROWTH


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows whose two ends are not in one class yet."""
    rows = pairs.join(roots.toDF("a", "_a"), "a", "left").join(roots.toDF("b", "_b"), "b", "left")
    return rows.where(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select(*pairs.columns)


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class, that whose id is the class id; of rows that
    repeat an id the one with the smallest text stays. Rows without an id all stay, and
    so do texts without words. Other columns are carried whatever their names."""
    gone = near_classes(docs).where("doc_id <> class_id").select("doc_id").distinct()
    rank = fresh(docs, "rank")
    same_id = Window.partitionBy("doc_id").orderBy("text")
    kept = docs.where("doc_id is not null").join(gone, "doc_id", "left_anti")
    kept = kept.withColumn(rank, F.row_number().over(same_id)).where(F.col(rank) == 1).drop(rank)
    return kept.select(*docs.columns).unionByName(docs.where("doc_id is null"))
