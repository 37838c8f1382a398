"""Patched frame-of-reference blocks for 32-bit token ids.

File: magic; blocks; footer. A block holds up to 512 ids: their minimum is subtracted, the
rest is packed at a width that fits the share ``FIT`` of them, and the higher bits of the
others stand in an exception list. The footer has the byte offset of every block, the ids
per document and the document ids; its own length and the magic end the file.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np

MAGIC = b"PFB1"
BLOCK = 512
FIT = 0.9
LANES = 64
_HEAD = struct.Struct("<IHHB")
_FOOT = struct.Struct("<QQQ")
_U64 = np.uint64


def _bits(x: np.ndarray) -> np.ndarray:
    """Bit length of 32-bit values."""
    return np.ceil(np.log2(x.astype(np.float64) + 1)).astype(np.int64)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of 512 values of ``width`` bits as rows of 64-bit words, 64 values at a time."""
    groups = values.reshape(-1, LANES).astype(_U64)
    out = np.zeros((len(groups), width), dtype=_U64)
    for i in range(LANES):
        word, shift = divmod(i * width, 64)
        out[:, word] |= groups[:, i] << _U64(shift)
        if shift + width > 64:
            out[:, word + 1] |= groups[:, i] >> _U64(64 - shift)
    return out.reshape(len(values), -1)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    groups = words.reshape(-1, width)
    out = np.empty((len(groups), LANES), dtype=_U64)
    low = _U64((1 << width) - 1)
    for i in range(LANES):
        word, shift = divmod(i * width, 64)
        value = groups[:, word] >> _U64(shift)
        if shift + width > 64:
            value |= groups[:, word + 1] << _U64(64 - shift)
        out[:, i] = value & low
    return out.reshape(len(words), -1)


def encode(ids: np.ndarray) -> list[bytes]:
    """The blocks of ``ids``; only the last may hold fewer than 512."""
    blocks = -(-len(ids) // BLOCK)
    if not blocks:
        return []
    padded = np.full(blocks * BLOCK, ids[-1], dtype=np.uint32)
    padded[: len(ids)] = ids
    rows = padded.reshape(blocks, BLOCK)
    least = rows.min(axis=1)
    rest = rows - least[:, None]
    at = int(FIT * BLOCK)
    widths = _bits(np.partition(rest, at, axis=1)[:, at])
    out: list[bytes] = [b""] * blocks
    for width in np.unique(widths):
        own = np.flatnonzero(widths == width)
        some = rest[own]
        high = some >> np.uint32(width) if width < 32 else np.zeros_like(some)
        packed = _pack(some & np.uint32((1 << int(width)) - 1), int(width)) if width else np.zeros((len(own), 0), _U64)
        for k, b in enumerate(own):
            where = np.flatnonzero(high[k])
            count = min(BLOCK, len(ids) - b * BLOCK)
            out[b] = b"".join((
                _HEAD.pack(int(least[b]), count, len(where), int(width)), packed[k].astype("<u8").tobytes(),
                where.astype("<u2").tobytes(), high[k][where].astype("<u4").tobytes(),
            ))
    return out


def decode(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of consecutive blocks; ``starts`` are their offsets in ``data``."""
    heads = [_HEAD.unpack_from(data, s) for s in starts.tolist()]
    out = np.zeros((len(heads), BLOCK), dtype=np.uint32)
    widths = np.array([h[3] for h in heads])
    for width in np.unique(widths):
        own = np.flatnonzero(widths == width)
        size = BLOCK // 64 * int(width)
        if width:
            words = np.stack([np.frombuffer(data, "<u8", size, starts[b] + _HEAD.size) for b in own])
            out[own] = _unpack(words, int(width)).astype(np.uint32)
        for b in own:
            n = heads[b][2]
            if n:
                at = int(starts[b]) + _HEAD.size + 8 * size
                where = np.frombuffer(data, "<u2", n, at)
                out[b, where] |= np.frombuffer(data, "<u4", n, at + 2 * n) << np.uint32(width)
    out += np.array([h[0] for h in heads], dtype=np.uint32)[:, None]
    counts = np.array([h[1] for h in heads])
    return out[np.arange(BLOCK) < counts[:, None]]


class Writer:
    """Writes one file to an open binary stream, a run of documents at a time."""

    BUFFER = 1 << 20

    def __init__(self, stream) -> None:
        self.stream = stream
        stream.write(MAGIC)
        self.at = len(MAGIC)
        self.starts: list[int] = []
        self.counts: list[int] = []
        self.names: list[int | None] = []
        self.held: list[np.ndarray] = []
        self.waiting = 0
        self.total = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.names.append(doc_id)
        self.counts.append(len(ids))
        self.held.append(ids)
        self.waiting += len(ids)
        self.total += len(ids)
        if self.waiting >= self.BUFFER:
            self._flush(False)

    def _flush(self, end: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        full = len(ids) if end else len(ids) // BLOCK * BLOCK
        for block in encode(ids[:full]):
            self.starts.append(self.at)
            self.stream.write(block)
            self.at += len(block)
        self.held, self.waiting = [ids[full:]], len(ids) - full

    def close(self) -> None:
        self._flush(True)
        named = np.array([n is not None for n in self.names], dtype=np.uint8)
        names = np.array([n or 0 for n in self.names], dtype="<i8")
        for part in (np.array(self.starts, "<u8"), np.array(self.counts, "<u8"), named, names):
            self.stream.write(part.tobytes())
        self.stream.write(_FOOT.pack(self.at, len(self.starts), len(self.counts)) + MAGIC)


def read(file, chunk: int = 2048) -> Iterator[tuple[int | None, np.ndarray]]:
    """Documents of a file (seekable, with ``size``, ``seek`` and ``read``) in its order,
    ``chunk`` blocks in memory at a time besides the document being put together."""
    size = file.size()
    file.seek(size - _FOOT.size - len(MAGIC))
    tail = file.read()
    if tail[-len(MAGIC):] != MAGIC:
        raise ValueError("not a token block file, or cut short")
    end, blocks, docs = _FOOT.unpack(tail[: _FOOT.size])
    file.seek(end)
    foot = file.read(8 * blocks + 17 * docs)
    starts = np.frombuffer(foot, "<u8", blocks).astype(np.int64)
    counts = np.frombuffer(foot, "<u8", docs, 8 * blocks).astype(np.int64)
    named = np.frombuffer(foot, np.uint8, docs, 8 * (blocks + docs))
    names = np.frombuffer(foot, "<i8", docs, 8 * (blocks + docs) + docs)
    stops = np.append(starts[1:], end)
    held, at = np.zeros(0, np.uint32), 0
    for d in range(docs):
        parts, need = [], int(counts[d])
        while need > len(held):
            parts.append(held)
            need -= len(held)
            last = min(at + chunk, blocks)
            file.seek(int(starts[at]))
            held = decode(file.read(int(stops[last - 1] - starts[at])), starts[at:last] - starts[at])
            at = last
        parts.append(held[:need])
        held = held[need:]
        yield (int(names[d]) if named[d] else None), np.concatenate(parts)
