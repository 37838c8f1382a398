"""Writers for every output; each dataset has its own path and a fixed column order."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mentionlake.operators.articles import METADATA_FIELDS, assign_chunks, assign_shards
from mentionlake.operators.rollup import FACT_KEY, new_facts

CSV = {"header": True, "quote": '"', "escape": '"'}


def write_metadata_shards(
    metadata: DataFrame, path: str, shards: int = 128, files_per_shard: int = 4
) -> None:
    """gzip JSON lines, one folder per shard, each cut into a few files by id hash."""
    rows = assign_shards(metadata, shards).select(*METADATA_FIELDS, "shard")
    part = F.pmod(F.xxhash64("pmcid"), F.lit(files_per_shard))
    rows.repartition(F.col("shard"), part).write.mode("overwrite").partitionBy("shard").option(
        "compression", "gzip"
    ).json(path)


def write_id_chunks(ids: DataFrame, path: str, chunks: int, rows_per_file: int = 1_000_000) -> None:
    """One folder of id lines per chunk, in numeric order; long chunks take more files."""
    rows = assign_chunks(ids, chunks)
    part = F.floor(F.col("rank") / rows_per_file)
    rows = rows.repartition(F.col("chunk"), part).sortWithinPartitions("chunk", "rank")
    rows.select("pmcid", "chunk").write.mode("overwrite").partitionBy("chunk").text(path)


def write_texts(texts: DataFrame, path: str) -> None:
    texts.where(F.length("text") > 0).write.mode("overwrite").parquet(path)


def write_summary(summary: DataFrame, path: str) -> None:
    summary.select("doc_id", "resource_name", "alias", "match_count", "mean_confidence").write.mode(
        "overwrite"
    ).csv(path, **CSV)


def write_counts(counts: DataFrame, path: str) -> None:
    counts.select("resource_name", "alias", "prediction", "n").write.mode("overwrite").parquet(path)


def write_specificity(scores: DataFrame, path: str) -> None:
    """Most specific first; file order follows the sort."""
    scores.orderBy(F.desc("specificity"), F.desc("positives"), "resource_name", "alias").write.mode(
        "overwrite"
    ).csv(path, **CSV)


def write_by_resource(examples: DataFrame, path: str) -> None:
    """Examples in one folder per resource."""
    examples.withColumn("resource", F.col("resource_name")).write.mode("overwrite").partitionBy(
        "resource"
    ).csv(path, **CSV)


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What an earlier run wrote, or nothing. The files to read are listed before any
    new one appears, so appending to the same folder is safe."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def append_facts(facts: DataFrame, path: str) -> None:
    """Append the facts whose key is not stored yet; running it twice adds nothing."""
    stored = _stored(facts.sparkSession, path, facts.schema)
    new_facts(facts, stored.select(*FACT_KEY)).write.mode("append").parquet(path)


def append_publications(facts: DataFrame, path: str) -> None:
    """The publication side of the facts: one row per article not stored yet."""
    rows = facts.select("pmcid", "title").dropDuplicates(["pmcid"])
    stored = _stored(rows.sparkSession, path, rows.schema)
    rows.join(stored.select("pmcid"), "pmcid", "left_anti").write.mode("append").parquet(path)
