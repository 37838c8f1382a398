"""A store of facts that batches are committed to, once each.

    facts/bucket=N/         one row per fact key
    publications/bucket=N/  one row per article, all metadata columns
    commits/                the batch ids that are in

The bucket is a hash of the article id, so a batch looks only at the partitions its own
articles fall into, however long the history is. A batch whose id is in ``commits`` is
not looked at again. One that failed between its writes is replayed: keys that it had
stored already are skipped, and its id is recorded last.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mentionlake.functions.ids import md5_shard
from mentionlake.operators.articles import METADATA_FIELDS
from mentionlake.operators.rollup import FACT_KEY
from mentionlake.operators.sizing import broadcast_if_small

BUCKETS = 256


def read_part(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of one dataset of the store with their ``bucket``; none before the first commit."""
    schema = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def unstored(rows: DataFrame, path: str, key: list[str], buckets: int = BUCKETS) -> DataFrame:
    """``rows``, one per key, that the dataset at ``path`` lacks, with their ``bucket``.

    The buckets of the batch, at most ``buckets`` numbers, become a partition filter of
    the read. A null id has bucket 0, and a key with a null part equals another such key.
    """
    known = read_part(rows.sparkSession, path, rows.schema)
    bucket = F.coalesce(md5_shard(F.col("pmcid"), buckets), F.lit(0)).cast("int")
    rows = rows.withColumn("bucket", bucket).dropDuplicates(key)
    asked = [r["bucket"] for r in rows.select("bucket").distinct().collect()]
    stored = known.where(F.col("bucket").isin(asked)).select(*(F.col(k).alias(f"_{k}") for k in key), F.col("bucket").alias("_bucket"))
    same = F.col("bucket") == F.col("_bucket")
    for k in key:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    return rows.join(stored, same, "left_anti")


def _append(rows: DataFrame, path: str) -> None:
    # One writer per bucket, so a batch adds at most one file to each.
    rows.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(path)


def committed(spark: SparkSession, path: str) -> DataFrame:
    """``batch_id`` of the batches that are in."""
    schema = T.StructType([T.StructField("batch_id", T.StringType())])
    return read_part(spark, f"{path}/commits", schema).drop("bucket")


def commit_facts(
    facts: DataFrame, path: str, batch_id: str, publications: DataFrame | None = None, buckets: int = BUCKETS
) -> bool:
    """Adds a batch of facts, and of ``publications`` (all metadata fields) the articles
    the facts are of; whether the batch was new. Read more than once: pass a stored batch."""
    spark = facts.sparkSession
    if not committed(spark, path).where(F.col("batch_id") == batch_id).isEmpty():
        return False
    if publications is not None:
        articles = broadcast_if_small(facts.select("pmcid").distinct())
        rows = publications.select(*METADATA_FIELDS).join(articles, "pmcid", "left_semi")
        _append(unstored(rows, f"{path}/publications", ["pmcid"], buckets), f"{path}/publications")
    _append(unstored(facts, f"{path}/facts", list(FACT_KEY), buckets), f"{path}/facts")
    spark.createDataFrame([(batch_id,)], "batch_id string").coalesce(1).write.mode("append").parquet(f"{path}/commits")
    return True
