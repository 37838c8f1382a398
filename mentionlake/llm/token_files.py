"""Token-id files: encode texts, write them as block files in id order, read them back."""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mentionlake.functions.vocabularies import splits_at_spaces
from mentionlake.llm import pfor
from mentionlake.llm.hashing import pieces, text_bytes, word_spans
from mentionlake.llm.ngram_table import Table, padded
from mentionlake.llm.stage import new_folder, staged

END_ID = 2
#: Words whose ids a worker remembers; then it starts afresh.
REMEMBERED = 1_500_000
#: What one task reads back.
TASK_TOKENS = 32 << 20
#: Punctuation that parts from the letters before it: every byte of it is one character.
_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[list(b".,!|:;?$%&*#")] = True
_LETTERS = np.array([chr(b).isalpha() and b < 128 for b in range(256)])
#: Between words: the white space that a normal form can neither make nor take away.
_BETWEEN = np.zeros(256, dtype=bool)
_BETWEEN[[0x20, 0x09, 0x0A, 0x0D]] = True


def _units(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, start, end and kind of each unit, and the number of the first unit of each row.

    A word of plain letters and the punctuation behind them is cut in two units, the letters
    in lower case (kind 1) and the punctuation; any other word is one unit as it stands
    (kind 0). Plain are A to Z and the letters U+00C0 to U+00FF, whose lower case and normal
    form are single letters, whatever stands beside them.
    """
    starts, ends, first = word_spans(data, rows, _BETWEEN)
    if not len(starts):
        return data, starts, ends, np.zeros(0, np.int64), first
    after = np.append(data[1:], np.uint8(0))
    pair = (data == 0xC3) & (after >= 0x80) & (after <= 0xBF) & (after != 0x97) & (after != 0xB7)
    second = np.append(False, pair[:-1])
    letter, point = _LETTERS[data] | pair | second, _PUNCTUATION[data]
    # What no plain word has: other bytes, and a letter behind punctuation.
    odd = ~(letter | point)
    odd[1:] |= letter[1:] & point[:-1]
    odd[starts] = ~(letter | point)[starts]
    seen = np.append(0, np.cumsum(odd))
    plain = seen[ends] == seen[starts]
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    inside[starts[plain]] += 1
    inside[ends[plain]] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int8) > 0
    raised = inside & ((data >= 65) & (data <= 90) | second & (data <= 0x9E))
    cut = np.flatnonzero(inside[1:] & point[1:] & letter[:-1]) + 1
    cut = cut[np.searchsorted(starts, cut, side="right") == np.searchsorted(starts, cut - 1, side="right")]
    units = np.sort(np.concatenate([starts, cut]))
    word = np.searchsorted(starts, units, side="right") - 1
    last = np.append(word[1:] != word[:-1], True)
    stops = np.where(last, ends[word], np.append(units[1:], 0))
    return data + raised.astype(np.uint8) * np.uint8(32), units, stops, (plain[word] & letter[units]).astype(np.int64), np.searchsorted(units, rows)


class WordEncoder:
    """Ids of texts, each distinct word of a batch encoded once.

    Words stand between ASCII white space; plain ones part from the punctuation behind them
    and from their case. A batch's units are interned in a table; new ones are encoded, those
    of plain letters together as one text, all others one by one by the tokenizer, and
    occurrences gather the ids of their units. A tokenizer whose file
    does not say that this is exact encodes whole texts.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = splits_at_spaces(path)
        self.folds = self.by_word  # such a file lower-cases, so plain words may be lower-cased before
        size = self.tokenizer.get_vocab_size()
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.known: dict[bytes, bytes] = {}

    def _encode_each(self, words: list[str]) -> None:
        for word, found in zip(words, self.tokenizer.encode_batch_fast(words, add_special_tokens=False), strict=True):
            self.known[word.encode()] = np.array(found.ids, "<u4").tobytes()

    def _encode_letters(self, words: list[str]) -> None:
        """Words of letters alone, a thousand at a time as one text, cut at word ends."""
        groups = [words[i : i + 1000] for i in range(0, len(words), 1000)]
        texts = [" ".join(g) for g in groups]
        for group, found in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(found.ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(group):
                self._encode_each(group)
                continue
            data, at = ids.tobytes(), 0
            for word, end in zip(group, (4 * ends).tolist(), strict=True):
                self.known[word.encode()] = data[at:end]
                at = end

    def _interned(self, texts: pa.Array | list) -> tuple[Table, np.ndarray, list[bytes], np.ndarray]:
        """The units of a batch, the first unit of each row, the ids of each distinct one, and
        how many ids the unit in each slot has."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        data, rows = text_bytes(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        data, starts, ends, kind, first = _units(data, rows)
        table = Table(padded(data), starts, ends - starts)
        words = table.keys()
        new = [(w, k) for w, k in zip(words, kind[table.owner].tolist(), strict=True) if w not in self.known]
        self._encode_letters([w.decode() for w, k in new if k])
        self._encode_each([w.decode() for w, k in new if not k])
        found = [self.known[w] for w in words]
        size = np.zeros(table.size, np.int64)
        size[table.used] = [len(f) // 4 for f in found]
        return table, first, found, size

    def counts(self, texts: pa.Array) -> list[int]:
        """How many ids each text has."""
        if not self.by_word:
            return [len(ids) for ids in self(texts)]
        table, first, _, size = self._interned(texts)
        stops = np.concatenate([[0], np.cumsum(size[table.slot])])
        return np.diff(stops[first]).tolist()

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        if not self.by_word:
            plain = [t or "" for t in texts.to_pylist()]
            return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(plain, add_special_tokens=False)]
        table, first, found, size = self._interned(texts)
        ids = np.frombuffer(b"".join(found), "<u4")
        begin = np.zeros(table.size, np.int64)
        begin[table.used] = np.cumsum(size[table.used]) - size[table.used]
        each = size[table.slot]
        stops = np.concatenate([[0], np.cumsum(each)])
        out = ids[np.repeat(begin[table.slot] - stops[:-1], each) + np.arange(stops[-1])]
        edges = stops[first].tolist()
        return [out[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _opened(path: str):
    fs, inner = pafs.FileSystem.from_uri(path)
    return fs, inner


def _write(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str) -> Iterator[pa.RecordBatch]:
    """One file per task under a name of its own, so a repeated task harms nothing; only
    the manifest row of the attempt that Spark commits is ever read."""
    part = TaskContext.get().partitionId()
    path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.pfb"
    encode, writer, stream = None, None, None
    for batch in batches:
        for piece in pieces(batch):
            if writer is None:
                encode = encoder(tokenizer)
                fs, inner = _opened(path)
                fs.create_dir(inner.rpartition("/")[0], recursive=True)
                stream = fs.open_output_stream(inner)
                writer = pfor.Writer(stream)
            for doc_id, ids in zip(piece.column("doc_id").to_pylist(), encode(piece.column("text")), strict=True):
                writer.add(doc_id, np.append(ids, np.uint32(END_ID)))
    if writer is not None:
        writer.close()
        stream.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int64()), pa.array([path]), pa.array([len(writer.counts)], pa.int64()), pa.array([writer.total], pa.int64())],
            names=["part", "path", "n_docs", "n_tokens"],
        )


def write_tokens(docs: DataFrame, tokenizer: str, folder: str) -> DataFrame:
    """Writes ``docs`` (``doc_id``, ``text``) under ``folder`` and returns the manifest:
    ``part, path, n_docs, n_tokens``, one row per file.

    Documents stand in ascending id order, in files in order of ``part``; null ids come
    first, rows that repeat an id follow each other by text. A null text is empty: its
    only id is the end id.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tie = F.xxhash64("text")
    rows = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    manifest = rows.mapInArrow(
        partial(_write, folder=folder, tokenizer=tokenizer), "part bigint, path string, n_docs bigint, n_tokens bigint"
    )
    return staged(manifest, folder, "manifest")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
            fs, inner = _opened(path)
            with fs.open_input_file(inner) as file:
                rows: list[tuple] = []
                for doc_id, ids in pfor.read(file):
                    rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                    if len(rows) == 10_000:
                        yield _digests(rows)
                        rows = []
                yield _digests(rows)


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "n_tokens", "ids_crc32"]
    )


def read_tokens(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files' contents.

    ``start`` counts the ids of all documents before it: running sums over one row per
    file, then within the file.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("part", "path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"))
    # A number of its own, else adaptive execution gives these few rows to one task.
    total = manifest.agg(F.sum("n_tokens")).first()[0] or 0
    tasks = max(manifest.sparkSession.sparkContext.defaultParallelism, total // TASK_TOKENS + 1)
    return files.repartition(tasks, "part").mapInArrow(_read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes the files in a fresh folder of the shared space and reads them back."""
    return read_tokens(write_tokens(docs, tokenizer, new_folder(docs.sparkSession, "tokens")))
