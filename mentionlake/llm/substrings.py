"""Repeated passages by seed and extend.

Seeds are winnowed anchors: of the ``SEED``-word runs inside every window of ``LENGTH``
words the one with the smallest hash, so equal windows always share their anchor.
Documents meet on anchors. Each occurrence is extended both ways over all the windows
that chose it; its context is the hash of that stretch. Within an anchor only the first
occurrence of each context, its leader, goes on; the others repeat it whole. Leaders of
different contexts are compared window by window. Covered windows that overlap join
into maximal repeats, and every word of them goes.

Occurrences are combined inside each task before any shuffle, and then streamed in
sorted order past a task that remembers one leader: no group is ever held, and no pair
of documents is ever formed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionlake.llm.hashing import Runs, mix, pieces, shingles, word_hashes
from mentionlake.llm.stage import new_folder, staged

LENGTH = 20
SEED = 6
_SECOND = np.uint64(0xA0761D6478BD642F)
_CHOICES = LENGTH - SEED + 1
_SEEDS = "anchor bigint, context bigint, doc_id bigint, row bigint, start bigint, n int, kind int"
_FOUND = "doc_id bigint, row bigint, start bigint, n int, kind int"
#: Kinds of rows: an occurrence still to be compared; windows known to be repeats; a
#: leader whose windows are to be compared one by one.
OPEN, COVERED, LEADER = 0, 1, 2


def anchors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, context hash, first own window and number of own windows."""
    n = len(words) - LENGTH + 1
    if n <= 0:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    seeds = shingles(words, SEED)
    chosen = np.lib.stride_tricks.sliding_window_view(seeds, _CHOICES).argmin(axis=1) + np.arange(n)
    first = np.flatnonzero(np.append(True, chosen[1:] != chosen[:-1]))
    count = np.diff(np.append(first, n))
    at = chosen[first]
    stretch = Runs(words)(first, first + count - 1 + LENGTH)
    context = mix(stretch ^ ((at - first) * 64 + count).astype(np.uint64))
    return seeds[at], context, first.astype(np.int64), count.astype(np.int64)


def _rows(names: str, *columns: np.ndarray) -> pa.RecordBatch:
    fields = [f.split(" ") for f in names.split(", ")]
    kinds = {"bigint": (pa.int64(), np.int64), "int": (pa.int32(), np.int32)}
    arrays = [
        pa.array(c.view(np.int64) if c.dtype == np.uint64 else c.astype(kinds[t][1], copy=False), kinds[t][0])
        for (_, t), c in zip(fields, columns, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, names=[f for f, _ in fields])


def _combined(key: np.ndarray, second: np.ndarray, doc: np.ndarray, row: np.ndarray, start: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Rows of one piece of input; of equal contexts only the first stays open. The rest
    is covered and travels under a key of its own, so that a hot key does not grow."""
    order = np.lexsort((start, row, doc, second, key))
    key, second, doc, row, start, n = (x[order] for x in (key, second, doc, row, start, n))
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (second[1:] != second[:-1])
    lead = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
    covered = (doc != doc[lead]) | (row != row[lead]) | (start != start[lead])
    keep = new | covered
    spread = mix((doc ^ row).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + start.astype(np.uint64))
    key = np.where(covered, spread, key)
    second = np.where(covered, np.uint64(0), second)
    kind = np.where(covered, COVERED, OPEN)
    return _rows(_SEEDS, *(x[keep] for x in (key, second, doc, row, start, n, kind)))


def _seed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            for piece in pieces(batch):
                words, offsets = word_hashes(piece.column("text"))
                ids, keys = (piece.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "row"))
                found = [anchors(words[offsets[i] : offsets[i + 1]]) for i in range(len(ids))]
                doc, row = (np.repeat(x, [len(f[0]) for f in found]) for x in (ids, keys))
                if len(doc):
                    a, c, s, n = (np.concatenate([f[k] for f in found]) for k in range(4))
                    yield _combined(a, c, doc, row, s, n)


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of the leaders of each text, under two hashes of its own, 128 bits."""
    with np.errstate(over="ignore"):
        for batch in batches:
            for piece in pieces(batch):
                words, offsets = word_hashes(piece.column("text"))
                ids, keys = (piece.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "row"))
                spans = piece.column("spans")
                starts, docs, rows, hashes, seconds = [], [], [], [], []
                for i in range(len(ids)):
                    own = spans[i].values
                    first, count = (own.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
                    at = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    at = np.unique(at)
                    starts.append(at)
                    docs.append(np.full(len(at), ids[i]))
                    rows.append(np.full(len(at), keys[i]))
                    own = words[offsets[i] : offsets[i + 1]]
                    hashes.append(Runs(own)(at, at + LENGTH))
                    seconds.append(Runs(mix(own ^ _SECOND))(at, at + LENGTH))
                if starts:
                    key, second, doc, row, at = (np.concatenate(x) for x in (hashes, seconds, docs, rows, starts))
                    yield _combined(key, second, doc, row, at, np.ones(len(at), np.int64))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor, context and place: repeats of a leader are covered; leaders
    of an anchor with several contexts are passed on."""
    last_key = last_context = None
    lead_at = (0, 0, 0)
    pending: tuple | None = None
    for batch in batches:
        key, context, doc, row, start, n, kind = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if not len(key):
            continue
        new_key = np.append(key[0] != last_key, key[1:] != key[:-1])
        new = new_key | np.append(context[0] != last_context, context[1:] != context[:-1])
        lead = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
        known = lead >= 0
        led = [np.where(known, x[lead], before) for x, before in zip((doc, row, start), lead_at, strict=True)]
        done = kind == COVERED
        covered = done | (~new & ((doc != led[0]) | (row != led[1]) | (start != led[2])))
        leads = np.flatnonzero(new & ~done)
        more = ~new_key[leads]
        several = more.copy()
        several[:-1] |= more[1:]
        out = [np.column_stack((doc, row, start, n, np.full(len(n), COVERED)))[covered]]
        if len(leads):
            if pending is not None and more[0]:
                out.append(np.array([pending]))
            chosen = leads[several]
            out.append(np.column_stack((doc, row, start, n, np.full(len(n), LEADER)))[chosen])
            end = leads[-1]
            pending = None if several[-1] else (doc[end], row[end], start[end], n[end], LEADER)
        last_key, last_context = key[-1], context[-1]
        lead_at = tuple(x[-1] for x in led)
        rows = np.concatenate(out)
        yield _rows(_FOUND, *rows.T)


def _scanned(rows: DataFrame) -> DataFrame:
    return rows.repartition("anchor").sortWithinPartitions("anchor", "context", "doc_id", "row", "start").mapInArrow(_scan, _FOUND)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch):
            counts, removed, texts = [], [], []
            for text, spans in zip(piece.column("text").to_pylist(), piece.column("spans"), strict=True):
                words = (text or "").encode().split()
                gone = 0
                if spans.is_valid and len(spans.values):
                    edge = np.zeros(len(words) + 1, dtype=np.int64)
                    first, n = (spans.values.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
                    np.add.at(edge, first, 1)
                    np.add.at(edge, np.minimum(first + n - 1 + LENGTH, len(words)), -1)
                    cover = np.cumsum(edge[:-1]) > 0
                    gone = int(cover.sum())
                    words = [w for w, c in zip(words, cover.tolist(), strict=True) if not c]
                counts.append(len(words) + gone)
                removed.append(gone)
                texts.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text"],
            )


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` for every row of ``docs``.

    A word goes if a window of 20 consecutive words of its document covers it and the
    same words also start earlier: in a document with a smaller id, or before it in the
    same one. All windows are judged on the input. Words are what stands between spaces
    and the controls from tab to carriage return. Texts of fewer than 20 words, null and
    empty ones lose nothing. Rows that repeat an id and a text are one
    document, whose places are not earlier than each other; rows that repeat an id with
    another text are documents of their own, in the order of a hash of their texts. Rows
    without an id keep all words and make nobody else's a repeat.
    """
    folder = new_folder(docs.sparkSession, "substrings")
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))
    found = staged(_scanned(rows.where("doc_id is not null").mapInArrow(_seed_rows, _SEEDS)), folder, "seeds")

    def by_doc(parts: DataFrame) -> DataFrame:
        return parts.groupBy("doc_id", "row").agg(F.collect_list(F.struct("start", "n")).alias("spans"))

    leaders = by_doc(found.where(F.col("kind") == LEADER))
    windows = rows.join(leaders, ["doc_id", "row"]).select("doc_id", "row", "text", "spans").mapInArrow(_window_rows, _SEEDS)
    repeats = staged(_scanned(windows).where(F.col("kind") == COVERED), folder, "windows")
    covered = by_doc(found.where(F.col("kind") == COVERED).unionByName(repeats))
    return rows.join(covered, ["doc_id", "row"], "left").select("doc_id", "text", "spans").mapInArrow(
        _cut, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string"
    )
