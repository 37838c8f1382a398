"""WARC archives: write pages as records, read archives back by boundary chains.

Reading cuts files into chunks that are scanned apart. A scan takes every place that
looks like a record head as a candidate and emits its successor, the place where the
record says it ends. Magic words inside a payload make false candidates, so a candidate
counts only if the chain of successors from the start of the file reaches it. Within a
chunk a candidate is followed to the first successor outside; between chunks pointers
jump, twice as far each round, until the entries that the file start reaches are known.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionlake.llm.stage import new_folder, staged
from mentionlake.operators.sizing import broadcast_if_small

# Fixed values of the WARC 1.1 format.
MAGIC = b"WARC/1.1\r\n"
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK = 8 << 20
HEAD = 1 << 16
#: Bytes of archives that one task reads.
TASK = 128 << 20
_LENGTH = re.compile(rb"^Content-Length:[ \t]*(\d+)[ \t]*\r$", re.I | re.M)


def base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, n_bytes: int | None = None) -> bytes:
    """One record: a response with its payload, or a revisit of another page's, which
    needs only the payload's length."""
    size = len(payload) if n_bytes is None else n_bytes
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    name = "none" if page_id is None else page_id
    kind = "response" if refers_to is None else "revisit"
    clean = re.sub(r"[\x00-\x20\x7f]+", "%20", url or "")
    fields = [
        f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Target-URI: {clean}",
        "WARC-Date: 2024-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if refers_to is not None:
        fields += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return MAGIC + "\r\n".join(fields).encode() + b"\r\n\r\n" + block + END


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """One archive per task and attempt; the manifest names those of attempts that count."""
    path = f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc"
    stream, n, size = None, 0, 0
    for batch in batches:
        if stream is None and batch.num_rows:
            fs, inner = pafs.FileSystem.from_uri(path)
            fs.create_dir(inner.rpartition("/")[0], recursive=True)
            stream = fs.open_output_stream(inner)
        for i in range(batch.num_rows):
            page_id, url, html, digest, refers_to, n_bytes = (c[i].as_py() for c in batch.columns)
            data = record(page_id, url, (html or "").encode(), base32(digest), refers_to, n_bytes)
            stream.write(data)
            size += len(data)
            n += 1
    if stream is not None:
        stream.close()
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64()), pa.array([size], pa.int64())], names=["path", "n_records", "bytes"])


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes ``pages`` (``page_id``, ``url``, ``html``) under ``folder``; the manifest has
    ``path, n_records, bytes``.

    Of pages with equal payloads (a null html is an empty one) that with the largest id is
    written whole, the others as revisits of it. Rows that repeat this largest id are all
    written whole, and so are rows without an id, which nobody refers to.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    ).withColumn("digest", F.sha1(F.coalesce("html", F.lit("")).cast("binary")))
    # Only digests and ids are shuffled; payloads meet the digests that several ids share.
    several = rows.groupBy("digest").agg(F.max("page_id").alias("largest"), F.min("page_id").alias("least"))
    several = staged(several.where("least < largest").select("digest", "largest"), folder, "several")
    refers_to = F.when(F.col("page_id") < F.col("largest"), F.col("largest"))
    rows = rows.join(broadcast_if_small(several), "digest", "left").select(
        "page_id", "url", F.when(refers_to.isNull(), F.col("html")).alias("html"), "digest", refers_to.alias("refers_to"),
        F.octet_length(F.coalesce("html", F.lit(""))).cast("bigint").alias("n"),
    )
    return staged(rows.mapInArrow(partial(_write, folder=folder), "path string, n_records bigint, bytes bigint"), folder, "manifest")


class _Heads:
    """Heads of the records that may start in one chunk: the chunk's bytes, read on to the
    first end of a head behind it. Candidates in rising order share what was found for
    the one before, so the bytes are searched once however many there are."""

    def __init__(self, file, at: int, stop: int, size: int) -> None:
        self.file, self.at, self.size, self.end, self.length, self.without = file, at, size, -1, None, -1
        self.data = file.read_at(min(stop + len(MAGIC) - 1, size) - at, at)

    def __call__(self, place: int) -> tuple[int, int] | None:
        """The record's length field and the offset behind its head (``place`` is one in the data)."""
        if self.end < place:
            self.end = self.data.find(END, place)
            while self.end < 0 and self.at + len(self.data) < self.size:
                known = max(place, len(self.data) - len(END))
                self.data += self.file.read_at(min(max(HEAD, len(self.data)), self.size - self.at - len(self.data)), self.at + len(self.data))
                self.end = self.data.find(END, known)
            if self.end < 0:
                self.end = len(self.data)
        if self.end == len(self.data):
            return None
        if self.without == self.end:
            return None
        if self.length is None or self.length.start() < place:
            self.length = _LENGTH.search(self.data, place, self.end + 2)
        if self.length is None:
            self.without = self.end  # nor has any later candidate before this end
            return None
        return int(self.length[1]), self.at + self.end + len(END)


def _head(file, at: int, size: int) -> tuple[bytes, int]:
    """The head of the record at ``at`` and the offset after it."""
    want = HEAD
    while True:
        data = file.read_at(min(want, size - at), at)
        end = data.find(END)
        if end >= 0:
            return data[: end + 2], at + end + len(END)
        want *= 8


def _candidates(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    """``path, entry, exit`` of every candidate of each chunk; a candidate whose chain
    breaks inside the chunk has no exit."""
    for batch in batches:
        for path, size, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            fs, inner = pafs.FileSystem.from_uri(path)
            stop = min(at + chunk, size)
            with fs.open_input_file(inner) as file:
                heads = _Heads(file, at, stop, size)
                found, place, own = [], heads.data.find(MAGIC), len(heads.data)
                while place >= 0:
                    head = heads(place)
                    if head:
                        found.append((at + place, head[1] + head[0] + len(END)))
                    place = heads.data.find(MAGIC, place + 1, own)
            exits: dict[int, int | None] = {}
            for entry, after in reversed(found):
                exits[entry] = exits.get(after) if after < stop else after if after <= size else None
            yield pa.RecordBatch.from_arrays(
                [pa.array([path] * len(exits), pa.string()), pa.array(list(exits), pa.int64()), pa.array(list(exits.values()), pa.int64())],
                names=["path", "entry", "exit"],
            )


def _records(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
    for batch in batches:
        for path, size, entry in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            fs, inner = pafs.FileSystem.from_uri(path)
            stop = min((entry // chunk + 1) * chunk, size)
            with fs.open_input_file(inner) as file:
                at, rows, held = entry, [], 0
                while at < stop:
                    head, body = _head(file, at, size)
                    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:] if x)
                    length = int(fields["Content-Length"])
                    http, _, payload = file.read_at(length, body).partition(END)
                    n, digest = len(payload), fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    refers = fields.get("WARC-Refers-To")
                    if refers is None and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"payload of {fields['WARC-Record-ID']} in {path} is damaged")
                    if refers is not None:
                        n, payload = int(_LENGTH.search(http + b"\r\n")[1]), None
                    name = lambda x: None if x is None or x.endswith(":none>") else int(x[10:-1])
                    rows.append((name(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], fields["WARC-Type"], name(refers), n, digest, payload))
                    at, held = body + length + len(END), held + length
                    if held > chunk:
                        yield pack(rows)
                        rows, held = [], 0
                if rows:
                    yield pack(rows)


def read_archives(manifest: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload`` of
    every record that the chain from its file's start reaches; length and digest of a
    revisit are those of the payload it refers to, which it does not repeat.

    A file that ends early gives the records before the break. An empty one gives none.
    """
    folder = new_folder(manifest.sparkSession, "warc")
    files = manifest.select("path", "bytes").where("bytes > 0")
    # A number of its own, else adaptive execution gives these few rows to one task.
    total = files.agg(F.sum("bytes")).first()[0] or 0
    tasks = max(manifest.sparkSession.sparkContext.defaultParallelism, total // TASK + 1)
    chunks = files.select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(chunk).cast("bigint"))).alias("at"))
    jump = chunks.repartition(tasks, "path", "at").mapInArrow(partial(_candidates, chunk=chunk), "path string, entry bigint, exit bigint")
    jump = staged(jump.where("exit is not null"), folder, "jump0")
    reached = staged(files.select("path", F.lit(0).cast("bigint").alias("entry")), folder, "reached0")
    count, step = reached.count(), 0
    while True:
        step += 1
        ahead = reached.join(jump, ["path", "entry"]).select("path", F.col("exit").alias("entry"))
        reached = staged(reached.union(ahead).distinct(), folder, f"reached{step}")
        now = reached.count()
        if now == count:
            break
        count = now
        further = jump.select("path", F.col("entry").alias("exit"), F.col("exit").alias("_exit"))
        jump = jump.join(further, ["path", "exit"], "left")
        jump = staged(jump.select("path", "entry", F.coalesce("_exit", "exit").alias("exit")), folder, f"jump{step}")
    starts = reached.join(files, "path").where("entry < bytes").select("path", "bytes", "entry")
    return starts.repartition(tasks, "path", "entry").mapInArrow(
        partial(_records, chunk=chunk),
        "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary",
    )


def archived(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` as archives in a fresh folder and reads them back."""
    return read_archives(write_archives(pages, new_folder(pages.sparkSession, "warc-files")))
