"""Word hashes of whole Arrow columns, computed over the bytes with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)
#: Bytes of text that are hashed at once; a longer text is hashed alone.
PIECE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        steps = np.full(size, _BASE, dtype=np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
        steps = np.full(size, _INVERSE, dtype=np.uint64)
        steps[0] = 1
        _inverses = np.multiply.accumulate(steps)
    return _powers, _inverses


def pieces(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``PIECE`` bytes of text."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + PIECE, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the column and the offset of each row's first byte; null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if texts.buffers()[2] is None:
        return np.zeros(0, dtype=np.uint8), offsets - offsets[0]
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


#: Anything in ASCII but letters and digits, for words without punctuation.
NOT_WORD = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def word_spans(data: np.ndarray, rows: np.ndarray, between: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of every word, and the number of the first word of each row."""
    inside = ~between[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[rows] = True
    before = np.empty(len(data), dtype=bool)
    if len(data):
        before[0] = False
        before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.append(inside[1:], False) if len(data) else before
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, rows)


def word_hashes(texts: pa.Array, between: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of every row, and the rows' offsets into them."""
    data, rows = text_bytes(texts)
    starts, ends, offsets = word_spans(data, rows, between)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), offsets
    powers, inverses = _tables(len(data))
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=total[1:])
    value = (total[ends] - total[starts]) * inverses[starts]
    length = (ends - starts).astype(np.uint64)
    return mix(value + length * np.uint64(0xD6E8FEB86659FD93)), offsets


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive words of one text."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        total = (total ^ words[i : i + n]) * np.uint64(0xFF51AFD7ED558CCD)
        total ^= total >> np.uint64(29)
    return mix(total)


class Runs:
    """Hashes of any runs of words of one text, from running sums."""

    def __init__(self, words: np.ndarray) -> None:
        powers, self._inverses = _tables(len(words) + 1)
        self._total = np.zeros(len(words) + 1, dtype=np.uint64)
        np.cumsum(words * powers[: len(words)], out=self._total[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        length = (end - start).astype(np.uint64)
        value = (self._total[end] - self._total[start]) * self._inverses[start]
        return mix(value + length * np.uint64(0xD6E8FEB86659FD93))
