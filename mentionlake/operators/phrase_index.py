"""Phrase search over a stored corpus: a positional inverted index that answers new aliases
without reading a text again."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlake.functions.text import phrase_text
from mentionlake.operators.sizing import broadcast_if_small

BUCKETS = 512
#: Parts of a bucket, by text: a very common word is this many tasks' work.
SLICES = 16
POSTINGS = "word string, doc_id {}, copy bigint, places array<int>, bucket int"
#: Texts whose words a worker gathers at once.
AT_ONCE = 256
WORDS = "word string, n_docs bigint, bucket int"


def _bucket(word: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(buckets)).cast("int")


def _split(c: Column) -> Column:
    return F.split(F.trim(phrase_text(c)), " ")


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each distinct word of each text, with its places in order."""
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            part = batch.slice(at, AT_ONCE)
            words = part.column("words")
            sizes = np.diff(words.offsets.to_numpy())
            each = words.flatten().dictionary_encode()
            row = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            code = each.indices.to_numpy().astype(np.int64)
            order = np.argsort(row * max(len(each.dictionary), 1) + code, kind="stable")
            row, code, place = row[order], code[order], place[order]
            starts = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (code[1:] != code[:-1]))) if len(row) else np.zeros(0, np.int64)
            places = pa.ListArray.from_arrays(pa.array(np.append(starts, len(row)), pa.int32()), pa.array(place, pa.int32()))
            kept = part.select(["doc_id", "copy"]).take(pa.array(row[starts]))
            yield pa.RecordBatch.from_arrays([each.dictionary.take(pa.array(code[starts])), *kept.columns, places], names=["word", "doc_id", "copy", "places"])


def build_index(texts: DataFrame, path: str, buckets: int = BUCKETS, slices: int = SLICES) -> None:
    """Writes the index of ``doc_id, text``: for each word and text the places of the word,
    and for each word how many texts hold it.

    Both tables are partitioned by a hash of the word and sorted by it, postings slice by slice.
    The places of a word are gathered in its text's row, so one row for each word of a text is
    shuffled, once, by bucket and a slice of the texts; one sort serves copies and layout. Rows with the same id and text are one text; rows that
    repeat an id with another text are searched by themselves. A row without id or text is
    left out, and so is a text without words.
    """
    rows = texts.where("doc_id is not null and text is not null")
    kind = dict(texts.dtypes)["doc_id"]
    rows = rows.select("doc_id", F.xxhash64("text").alias("copy"), _split(F.col("text")).alias("words"))
    words = rows.mapInArrow(_gathered, f"word string, doc_id {kind}, copy bigint, places array<int>").where("word <> ''")
    words = words.withColumn("bucket", _bucket(F.col("word"), buckets))
    words = words.withColumn("slice", F.pmod(F.xxhash64("doc_id", "copy"), F.lit(slices))).repartition("bucket", "slice")
    words = words.sortWithinPartitions("bucket", "slice", "word", "doc_id", "copy")
    postings = words.groupBy("bucket", "slice", "word", "doc_id", "copy").agg(F.any_value("places").alias("places"))
    postings.drop("slice").write.partitionBy("bucket").parquet(f"{path}/postings")
    stored = texts.sparkSession.read.schema(POSTINGS.format(kind)).parquet(f"{path}/postings")
    counts = stored.groupBy("bucket", "word").agg(F.count("*").alias("n_docs"))
    counts.repartition("bucket").sortWithinPartitions("bucket", "word").write.partitionBy("bucket").parquet(f"{path}/words")


def search_index(
    spark: SparkSession, path: str, aliases: DataFrame, buckets: int = BUCKETS, id_type: str = "bigint"
) -> DataFrame:
    """``doc_id, n_hits, first_place`` of every text that holds an alias as a phrase, next to the
    columns of ``aliases`` (one of them ``alias``): the same words in a row, case ignored.
    ``n_hits`` counts the places, overlapping ones too; words are numbered from 0.

    A phrase is opened by the word that fewest texts hold. Its other words are looked up for
    these texts only, by word and text, and their places, moved back by their distance in
    the phrase, must all name one start. Only the buckets of the words asked for are read.
    Aliases without a word, null ones and such with a word that no text holds give no row;
    repeated ones give the same rows each.
    """
    asked = aliases.select("alias").distinct().withColumn("words", _split(F.col("alias")))
    asked = asked.where(F.element_at("words", 1) != "").select("alias", F.size("words").alias("n"), F.posexplode("words").alias("at", "word"))
    asked = asked.withColumn("bucket", _bucket(F.col("word"), buckets))
    used = F.broadcast(asked.select("bucket").distinct())  # at most one row a bucket

    known = spark.read.schema(WORDS).parquet(f"{path}/words").join(used, "bucket")
    known = known.join(broadcast_if_small(asked.select("word").distinct()), "word", "left_semi").select("word", "n_docs")
    rare = asked.join(known, "word").groupBy("alias").agg(
        F.min(F.struct("n_docs", "at", "word", "bucket")).alias("rare"), F.count("*").alias("held"), F.max("n").alias("n")
    )
    opened = rare.where("held = n").select("alias", "n", F.col("rare.at").alias("at"), "rare.word", "rare.bucket")

    postings = spark.read.schema(POSTINGS.format(id_type)).parquet(f"{path}/postings").join(used, "bucket")
    text = ["doc_id", "copy"]
    starts = F.transform("places", lambda p: p - F.col("at"))
    postings = postings.join(broadcast_if_small(asked.select("word").distinct()), "word", "left_semi")
    first = postings.join(broadcast_if_small(opened), ["bucket", "word"]).select(
        "alias", "n", F.col("at").alias("opened_at"), *text, F.filter(starts, lambda s: s >= 0).alias("starts")
    )
    others = first.join(broadcast_if_small(asked.drop("n")), "alias").where(F.col("at") != F.col("opened_at"))
    others = others.join(postings, ["bucket", "word", *text]).select("alias", "n", *text, F.array_intersect("starts", starts).alias("starts"))
    each = first.select(*others.columns).unionByName(others).withColumn("start", F.explode("starts"))
    whole = each.groupBy("alias", "n", *text, "start").agg(F.count("*").alias("words")).where("words = n")
    hits = whole.groupBy("alias", *text).agg(F.count("*").alias("n_hits"), F.min("start").alias("first_place"))
    return aliases.join(hits.drop("copy"), "alias").select(*aliases.columns, "doc_id", "n_hits", "first_place")
