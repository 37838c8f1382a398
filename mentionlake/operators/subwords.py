"""Training windows in the sub-words of a public tokenizer, the alias in front of each."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from mentionlake.functions.vocabularies import splits_at_spaces

LENGTH = 512
OVERLAP = 128
#: Rows that a worker encodes at once.
AT_ONCE = 64
#: Words whose sub-words a worker remembers, then it starts afresh; longer words are not kept.
REMEMBERED = 1 << 19
LONGEST = 64
#: Between words: the white space that a normal form can neither make nor take away.
BETWEEN = re.compile(r"([ \t\n\r]+)")
WINDOWS = [("window_no", pa.int32()), ("n_tokens", pa.int32()), ("padding", pa.int32()), ("ids", pa.list_(pa.int32())), ("window", pa.string())]


class SubwordEncoder:
    """The sub-words of a text and their places in it. With ``by_word``, for a tokenizer whose
    sub-words never reach across white space, each distinct word is encoded once by a worker
    and words of a text gather the ids of theirs; else whole texts are encoded."""

    def __init__(self, spec: str, by_word: bool) -> None:
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_word = by_word
        self.known: dict[str, bytes] = {}

    def _ids_of(self, words: list[str]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known = {}
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        made = self.tokenizer.encode_batch(new, add_special_tokens=False)
        found = {w: np.array(e.ids, "<i4").tobytes() for w, e in zip(new, made, strict=True)}
        self.known.update((w, ids) for w, ids in found.items() if len(w) <= LONGEST)
        return [found[w] if w in found else self.known[w] for w in words]

    def __call__(self, text: str) -> tuple[np.ndarray, Callable[[int], tuple[int, int]]]:
        """The ids, and from the number of a sub-word where in the text it starts and ends."""
        if not self.by_word:
            whole = self.tokenizer.encode(text, add_special_tokens=False)
            return np.array(whole.ids, "<i4"), whole.token_to_chars
        parts = BETWEEN.split(text)  # words, the first and last maybe empty, and what is between
        words = parts[::2]
        found = self._ids_of(words)
        stops = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4)
        starts = np.append(0, np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts))))[:-1:2].tolist()
        inside = cache(partial(self.tokenizer.encode, add_special_tokens=False))

        def place(number: int) -> tuple[int, int]:
            at = int(np.searchsorted(stops, number, side="right"))
            begin, end = inside(words[at]).token_to_chars(number - int(stops[at]) + len(found[at]) // 4)
            return starts[at] + begin, starts[at] + end

        return np.frombuffer(b"".join(found), "<i4"), place


@cache
def _encoder(spec: str, by_word: bool) -> SubwordEncoder:
    return SubwordEncoder(spec, by_word)


def windows_of(encode: SubwordEncoder, alias: str, text: str, length: int, overlap: int) -> list[tuple[int, np.ndarray, str]]:
    """``window_no, ids, window`` of one example. All sub-words of the text come in some window;
    the alias leaves at least one more place than the overlap for them. Only the first and
    last sub-word of a window are looked up in the text."""
    front = encode(alias)[0][: length - overlap - 1]
    body, place = encode(text)
    room = length - len(front)
    step = room - overlap
    last = max(0, -(-(len(body) - room) // step))
    out = []
    for k in range(last + 1):
        ids = body[k * step : k * step + room]
        window = text[place(k * step)[0] : place(k * step + len(ids) - 1)[1]] if len(ids) else ""
        out.append((k, np.concatenate([front, ids]), window))
    return out


def _cut(batches: Iterator[pa.RecordBatch], spec, by_word: bool, keep: list[str], text: str, alias: str, length: int, overlap: int) -> Iterator[pa.RecordBatch]:
    encode = _encoder(spec.value, by_word)
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            part = batch.slice(at, AT_ONCE)
            rows, found = [], []
            for i, (a, t) in enumerate(zip(part.column(alias).to_pylist(), part.column(text).to_pylist(), strict=True)):
                cut = windows_of(encode, a or "", t or "", length, overlap)
                rows += [i] * len(cut)
                found += [(k, len(ids), length - len(ids), ids, window) for k, ids, window in cut]
            columns = list(zip(*found, strict=True))
            made = [pa.array(c, kind) for c, (_, kind) in zip(columns, WINDOWS, strict=True)]
            kept = part.select(keep).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, *made], names=[*keep, *(n for n, _ in WINDOWS)])


def subword_windows(
    rows: DataFrame, tokenizer: str, text: str = "text", alias: str = "alias", length: int = LENGTH, overlap: int = OVERLAP
) -> DataFrame:
    """Overlapping windows of ``rows``, each the sub-words of the alias and then of a part of
    the text: ``window_no, n_tokens, padding, ids, window``, next to every other column.

    ``tokenizer`` is the file of a public tokenizer; it is read once by the driver and broadcast,
    a few megabytes whatever the data. ``window`` is the part of the text a window covers, as it
    is written there. Two windows of an example share ``overlap`` sub-words of the text, and
    ``padding`` is what a window lacks. A null or empty text has one window, of the alias alone,
    and a null alias counts as empty; one that would fill the window is cut to leave room.
    Repeated rows get their windows each. Nothing is shuffled.
    """
    if not 0 <= overlap < length - 1:
        raise ValueError("a window must be longer than its overlap")
    keep = [c for c in rows.columns if c != text]
    clash = {n for n, _ in WINDOWS} & set(keep)
    if clash:
        raise ValueError(f"columns named as those of a window: {', '.join(sorted(clash))}")
    with open(tokenizer, encoding="utf-8") as file:
        spec = rows.sparkSession.sparkContext.broadcast(file.read())
    by_word = splits_at_spaces(tokenizer)
    schema = ", ".join([*(f"`{c}` {t}" for c, t in rows.dtypes if c != text), "window_no int, n_tokens int, padding int, ids array<int>, window string"])
    return rows.mapInArrow(partial(_cut, spec=spec, by_word=by_word, keep=keep, text=text, alias=alias, length=length, overlap=overlap), schema)
