"""Token counts through a digest cache: only contents never counted before are encoded."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlake.llm.hashing import pieces
from mentionlake.llm.stage import new_folder, staged
from mentionlake.llm.token_files import WordEncoder

LIMIT = 2048
_CACHE = "digest binary, n_tokens bigint"


def tokenizer_digest(path: str) -> str:
    """Names what the counts depend on: the vocabulary file's bytes, the library, its version."""
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    with open(path, "rb") as file:
        known = hashlib.sha256(file.read())
    known.update(f"{library.__name__} {library.__version__}".encode())
    return known.hexdigest()


def joins_spaces(path: str) -> bool:
    """Whether the tokenizer's own file says that it turns runs of white space into one
    space, and none of its added tokens has any inside."""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    normalizer = described.get("normalizer") or {}
    steps = normalizer.get("normalizers", [normalizer])
    joined = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    added = [t["content"] for t in described.get("added_tokens", [])]
    return joined in steps and not any(c.isspace() for a in added for c in a)


def content(text: Column, path: str) -> Column:
    """A text's normal form: texts of one form have one count. Null is empty; runs of ASCII
    white space become one space where the tokenizer does so itself."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.regexp_replace(text, "[\\x20\\t\\n\\r]+", " ") if joins_spaces(path) else text


def counter(path: str) -> Callable[[pa.Array], list[int]]:
    """Counts tokens of whole texts with the library that the file is for; where the file says
    that words may be encoded by themselves, each distinct word of a batch is encoded once."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts.to_pylist(), num_threads=1)]
    encode = WordEncoder(path)
    encode.tokenizer.no_truncation()
    encode.tokenizer.no_padding()
    return encode.counts


_counters: dict[str, Callable[[pa.Array], list[int]]] = {}


def _count(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    if path not in _counters:
        _counters[path] = counter(path)
    for batch in batches:
        for piece in pieces(batch):
            counts = _counters[path](piece.column("text"))
            yield pa.RecordBatch.from_arrays([piece.column("digest"), pa.array(counts, pa.int64())], names=["digest", "n_tokens"])


def stored_counts(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """``digest, n_tokens`` that the cache holds for one tokenizer; none if it is new."""
    folder = f"{cache}/tokenizer={version}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(_CACHE).parquet(folder) if there else spark.createDataFrame([], _CACHE)


def token_counts(docs: DataFrame, tokenizer: str, cache: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``docs`` (``doc_id``, ``text``).

    ``cache`` is a folder all executors share, with one Parquet folder for each tokenizer
    digest and a row per content digest (SHA-256). Contents it lacks are encoded once,
    whichever rows hold them, and appended; a run that is cut off appends nothing, and two
    runs at once at worst append the same count twice, which does no harm.

    Of equal contents the row with the smallest id is encoded: ids and digests are
    shuffled to find it, then the texts meet those rows by digest and id, so a content
    that a third of all rows hold is spread by their ids. The counts return to the rows
    by digest, in a join whose hot digests adaptive execution splits.

    Null and empty texts have 0 bytes and 0 tokens. Rows that repeat an id, and those
    without one, get a result each. An empty table gives none. Other columns are not read.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "token-counts")
    version = tokenizer_digest(tokenizer)
    text = content(F.col("text"), tokenizer)
    keyed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("bigint").alias("n_bytes"), text.alias("text"),
    )
    keys = staged(keyed.select("doc_id", "digest", "n_bytes"), folder, "keys")
    first = keys.groupBy("digest").agg(F.min("doc_id").alias("first_id"))
    stored = stored_counts(spark, cache, version)
    misses = staged(first.join(stored, "digest", "left_anti"), folder, "misses")
    texts = keyed.select("doc_id", "digest", "text").withColumnRenamed("digest", "_d")
    texts = texts.join(misses, (F.col("_d") == F.col("digest")) & F.col("doc_id").eqNullSafe(F.col("first_id")))
    counted = texts.select("digest", "text").mapInArrow(partial(_count, path=tokenizer), _CACHE)
    counted = staged(counted, folder, "counted").dropDuplicates(["digest"])
    counted.write.mode("append").parquet(f"{cache}/tokenizer={version}")
    known = stored_counts(spark, cache, version).join(first, "digest", "left_semi").dropDuplicates(["digest"])
    known = staged(known, folder, "known")
    return keys.join(known, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
