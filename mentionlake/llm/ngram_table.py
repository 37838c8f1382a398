"""Words and n-grams of whole Arrow columns interned in an open-addressed NumPy table."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash

from mentionlake.llm.hashing import NOT_WORD, text_bytes, word_spans

# Multipliers of the public 64-bit xxHash, fixed values.
_P1 = np.uint64(0x9E3779B185EBCA87)
_P2 = np.uint64(0xC2B2AE3D27D4EB4F)
_P3 = np.uint64(0x165667B19E3779F9)
_P4 = np.uint64(0x85EBCA77C2B2AE63)
_P5 = np.uint64(0x27D4EB2F165667C5)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: Grams of up to so many bytes are hashed and compared eight bytes at a time, all at once.
_SHORT = 31


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as one little-endian number; ``data`` ends in padding."""
    return np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,))


def xxhash64(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """xxHash64 (seed 0) of each byte range; ``data`` ends in eight bytes of padding."""
    lanes = _lanes(data)
    with np.errstate(over="ignore"):
        h = _P5 + sizes.astype(np.uint64)
        at = starts.copy()
        for k in range(_SHORT // 8):
            on = np.flatnonzero(sizes >= 8 * (k + 1))
            x = _rotated(lanes[at[on]] * _P2, 31) * _P1
            h[on] = _rotated(h[on] ^ x, 27) * _P1 + _P4
            at[on] += 8
        on = np.flatnonzero(sizes % 8 >= 4)
        x = (lanes[at[on]] & np.uint64(0xFFFFFFFF)) * _P1
        h[on] = _rotated(h[on] ^ x, 23) * _P2 + _P3
        at[on] += 4
        for k in range(3):
            on = np.flatnonzero(sizes % 4 > k)
            h[on] = _rotated(h[on] ^ (data[at[on] + k].astype(np.uint64) * _P5), 11) * _P1
        h ^= h >> np.uint64(33)
        h *= _P2
        h ^= h >> np.uint64(29)
        h *= _P3
        h ^= h >> np.uint64(32)
    for i in np.flatnonzero(sizes > _SHORT).tolist():
        h[i] = xxhash.xxh64_intdigest(data[starts[i] : starts[i] + sizes[i]].data)
    return h


class Table:
    """An open-addressed table of byte ranges of ``data`` (which ends in eight bytes of
    padding), equal ones in one slot: ``slot`` of each range, ``used`` slots, and of each
    used slot the first range in it as ``owner``.

    A key goes to the slot its xxHash64 names or, where another key sits, to the next
    free one. Hashes only lead the search: a key counts as found when its bytes are equal.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
        self._data, self._lanes, self._starts, self._sizes = data, _lanes(data), starts, sizes
        hashes = xxhash64(data, starts, sizes)
        n = len(hashes)
        self.size = 1 << max(4, (2 * n).bit_length())
        owner = np.full(self.size, -1, dtype=np.int64)
        slot = (hashes & np.uint64(self.size - 1)).astype(np.int64)
        pending = np.arange(n)
        while len(pending):
            at = slot[pending]
            free = owner[at] < 0
            owner[at[free]] = pending[free]
            held = owner[at]
            same = hashes[held] == hashes[pending]
            same[same] = self._equal(held[same], pending[same])
            pending = pending[~same]
            slot[pending] = (slot[pending] + 1) & (self.size - 1)
        self.slot, self.used = slot, np.flatnonzero(owner >= 0)
        self.owner = owner[self.used]

    def keys(self) -> list[bytes]:
        """The bytes of each used slot's key."""
        view, starts = self._data.tobytes(), self._starts[self.owner]
        return [view[a:b] for a, b in zip(starts.tolist(), (starts + self._sizes[self.owner]).tolist(), strict=True)]

    def _equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the ranges ``a`` and ``b`` have the same bytes."""
        size = self._sizes[a]
        equal = size == self._sizes[b]
        for i in np.flatnonzero(equal & (size > _SHORT)).tolist():
            x, y, n = int(self._starts[a[i]]), int(self._starts[b[i]]), int(size[i])
            equal[i] = x == y or bool(np.array_equal(self._data[x : x + n], self._data[y : y + n]))
        short = size <= _SHORT
        for k in range(0, _SHORT, 8):
            on = np.flatnonzero(equal & short & (size > k))
            if not len(on):
                break
            rest = np.minimum(size[on] - k, 8).astype(np.uint64)
            mask = np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * rest)
            differ = self._lanes[self._starts[a[on]] + k] ^ self._lanes[self._starts[b[on]] + k]
            equal[on] = (differ & mask) == 0
        return equal


def padded(data: np.ndarray) -> np.ndarray:
    return np.concatenate([data, np.zeros(8, np.uint8)])


class Grams:
    """The 1- to ``longest``-grams of the words of a text column, equal ones in one slot.

    Words are runs of ASCII letters and digits and of anything beyond ASCII, with A-Z in
    lower case; the words of a gram are joined by one space. ``slot`` has the slot of
    each occurrence, ``rows`` the occurrences of each text as offsets, ``n_words`` its
    words. Of each slot, ``bucket`` has the crc32 of the gram's bytes modulo ``buckets``
    and ``count`` how often the batch has it; ``used`` lists the taken slots.
    """

    def __init__(self, texts: pa.Array, buckets: int, longest: int = 1) -> None:
        data, rows = text_bytes(texts)
        data, starts, sizes, self.rows, self.n_words = _occurrences(_LOWER[data], rows, longest)
        table = Table(padded(data), starts, sizes)
        self.slot, self.used = table.slot, table.used
        self.bucket = np.zeros(table.size, dtype=np.int64)
        self.bucket[self.used] = [zlib.crc32(k) % buckets for k in table.keys()]
        self.count = np.bincount(self.slot, minlength=table.size)

    def sums(self, of_bucket: np.ndarray) -> np.ndarray:
        """Per text, the sum of ``of_bucket`` over the buckets of all its grams."""
        gathered = of_bucket[self.bucket][self.slot]
        total = np.concatenate([[0], np.cumsum(gathered)])
        return total[self.rows[1:]] - total[self.rows[:-1]]

    def bucket_counts(self, buckets: int) -> np.ndarray:
        """Occurrences of the batch by bucket."""
        counts = np.zeros(buckets, dtype=np.int64)
        np.add.at(counts, self.bucket[self.used], self.count[self.used])
        return counts


def _occurrences(data: np.ndarray, rows: np.ndarray, longest: int) -> tuple[np.ndarray, ...]:
    """Bytes, start and size of each gram, the rows' offsets into them, the rows' words."""
    if longest > 1:
        data, rows = _single_spaced(data, rows)
    starts, ends, first = word_spans(data, rows, NOT_WORD)
    n_words = np.diff(first)
    if longest == 1:
        return data, starts, ends - starts, first, n_words
    row = np.repeat(np.arange(len(n_words)), n_words)
    at = np.arange(len(starts))
    parts = []
    for n in range(1, longest + 1):
        whole = at[at + n <= first[row + 1]]
        parts.append((row[whole], starts[whole], ends[whole + n - 1] - starts[whole]))
    row, starts, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(row, kind="stable")
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(n_words)))])
    return data, starts[order], sizes[order], offsets, n_words


def _single_spaced(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words alone, with one space behind each that something follows in its row."""
    inside = ~NOT_WORD[data]
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    firsts = rows[:-1][rows[:-1] < len(data)]
    keep[firsts] = inside[firsts]
    kept = np.concatenate([[0], np.cumsum(keep)])
    return np.where(inside, data, np.uint8(0x20))[keep], kept[rows]
