"""Reads that open only the files a list of ids needs: bundles by range, metadata by shard."""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import partial

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlake.functions.ids import id_number
from mentionlake.operators.articles import assign_bundles, assign_shards, parse_file_names
from mentionlake.operators.sizing import broadcast_if_small
from mentionlake.session import run_folder
from mentionlake.sources.readers import read_article_bundles

#: How many tasks look up files that a read names one by one.
DISCOVERY = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
#: Of bundles; 9, the library's own default, took 4.9 times as long for 4 % less.
GZIP_LEVEL = 4
STORED_METADATA = (
    "id string, pmcid string, pmid string, title string, firstPublicationDate string, authorString string, "
    "authorList string, citedByCount bigint, grantsList string, keywordList string, meshHeadingList string"
)


def list_bundles(spark: SparkSession, folder: str) -> DataFrame:
    """``path, bundle, start_id, end_id, length`` of the files whose name is an id range.
    The listing is Spark's own; no file is opened."""
    files = spark.read.format("binaryFile").load(folder).select("path", "length")
    files = files.withColumn("bundle", F.element_at(F.split("path", "/"), -1))
    named = parse_file_names(files, "bundle", keep=["path", "length"]).where("start_id is not null and end_id is not null")
    return named.select("path", "bundle", "start_id", "end_id", "length")


def assign_files(ids: DataFrame, listing: DataFrame, width: int = 100_000) -> DataFrame:
    """``pmcid, path, bundle``: the file that should hold each id, of several the one with
    the lowest range. Ids that are no numbers and ids in no range have none."""
    numbered = ids.select("pmcid").distinct().withColumn("id_num", id_number(F.col("pmcid")))
    return assign_bundles(numbered.where("id_num is not null"), listing, width).select("pmcid", "path", "bundle")


def read_wanted_articles(spark: SparkSession, folder: str, ids: DataFrame, width: int = 100_000) -> DataFrame:
    """``pmcid, xml, bundle`` of the articles named in ``ids`` (``pmcid``).

    A range join of ids and file names picks the files before the scan, which then opens no
    others; the driver gets one path for each picked file, as it does for any scan. Of an
    article that several bundles hold, the copy in the picked one is read. Null and
    repeated ids do no harm; an id that no bundle holds gives no row.
    The folder is listed once and the listing stored.
    """
    stored = run_folder(spark, "bundles")
    list_bundles(spark, folder).write.parquet(f"{stored}/listing")
    listing = spark.read.parquet(f"{stored}/listing")
    assign_files(ids, listing, width).write.parquet(f"{stored}/picked")
    wanted = spark.read.parquet(f"{stored}/picked")
    paths = [r["path"] for r in wanted.select("path").distinct().collect()]
    if not paths:
        return spark.createDataFrame([], "pmcid string, xml string, bundle string")
    with _looked_up_by_few_tasks(spark):
        articles = read_article_bundles(spark, paths)
    return articles.join(
        broadcast_if_small(wanted.select("pmcid", "bundle")), ["pmcid", "bundle"], "left_semi"
    ).select("pmcid", "xml", "bundle")


@contextmanager
def _looked_up_by_few_tasks(spark: SparkSession) -> Iterator[None]:
    """Files named one by one are looked up by two tasks for each core, not by one for each file."""
    before = spark.conf.get(DISCOVERY)
    spark.conf.set(DISCOVERY, str(min(int(before), 2 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(DISCOVERY, before)


def _write_files(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """One file per bundle, under a hidden name until it is whole, so a task that is
    repeated replaces it by an equal one."""
    fs, inner = pafs.FileSystem.from_uri(folder)
    fs.create_dir(inner, recursive=True)
    name, out, raw, hidden, done = None, None, None, "", []

    def close() -> None:
        if name is not None:
            out.close()
            raw.close()
            fs.move(hidden, f"{inner}/{name}")
            done.append(name)

    for batch in batches:
        for bundle, xml in zip(batch.column("bundle").to_pylist(), batch.column("xml").to_pylist(), strict=True):
            if xml is None:
                continue
            if bundle != name:
                close()
                name, hidden = bundle, f"{inner}/.{bundle}.{uuid.uuid4().hex}"
                raw = fs.open_output_stream(hidden, compression=None)
                out = gzip.GzipFile(fileobj=raw, mode="wb", compresslevel=GZIP_LEVEL, mtime=0) if name.endswith(".gz") else raw
            out.write(xml.encode() + b"\n")
    close()
    yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], names=["bundle"])


def write_bundles(articles: DataFrame, folder: str) -> int:
    """Writes ``articles`` (``pmcid, xml, bundle``) as files named by ``bundle``, in id
    order; returns their number. Rows without text or bundle are left out, those without text
    by the writer: a filter would be pushed below the text and compute it a second time."""
    rows = articles.where("bundle is not null").withColumn("id_num", id_number(F.col("pmcid")))
    rows = rows.repartition("bundle").sortWithinPartitions("bundle", "id_num", "pmcid").select("bundle", "xml")
    return rows.mapInArrow(partial(_write_files, folder=folder), "bundle string").count()


def read_metadata_shards(spark: SparkSession, path: str) -> DataFrame:
    """All records of the shard layout, with their ``shard`` as a partition column."""
    return spark.read.schema(f"{STORED_METADATA}, shard int").json(path)


def lookup_metadata(spark: SparkSession, path: str, ids: DataFrame, shards: int = 128) -> DataFrame:
    """The stored records of ``ids`` (``pmcid``), from the shards that can hold them.

    An id names its shard. The shards asked for, at most ``shards`` rows, are broadcast and
    prune the scan's partitions when the query runs; then ids meet records. Ids that are
    not stored, null ones and such without the prefix give no row, repeated ones give one.
    """
    wanted = assign_shards(ids.where(F.startswith("pmcid", F.lit("PMC"))).select("pmcid").distinct(), shards)
    wanted = wanted.select("pmcid", F.col("shard").cast("int").alias("shard"))
    asked = wanted.select("shard").distinct()
    records = read_metadata_shards(spark, path).join(F.broadcast(asked), "shard")
    fields = [f.split()[0] for f in STORED_METADATA.split(", ")]
    return records.join(broadcast_if_small(wanted), ["shard", "pmcid"], "left_semi").select(*fields)
