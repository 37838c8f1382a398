"""Readers for every input the jobs take; all return DataFrames with fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlake.functions.text import strip

LABELLED_SCHEMA = (
    "resource_name string, alias string, label int, article_topic_match boolean, "
    "pmcid string, paragraph_text string"
)
SUMMARY_SCHEMA = "doc_id string, resource_name string, alias string, match_count bigint, mean_confidence double"
DEFINITION_SCHEMA = "names array<string>, topics array<string>, ambiguous int"
CORE_SCHEMA = "short_name string, common_name string, full_name string"
VERSION_SCHEMA = "name string, date string, user string"
ARTICLE_END = "</article>"
# How an article states its own id, prefix optional.
ARTICLE_ID = r'(?is)<article-id[^>]*pub-id-type="pmc(?:id)?"[^>]*>\s*(?:PMC)?(\d+)\s*</article-id>'


def read_resource_table(spark: SparkSession, path: str | None = None, jdbc: dict | None = None) -> DataFrame:
    """The resource table from parquet or over JDBC; ``is_latest = 1`` is pushed down by
    :func:`~mentionlake.operators.dictionary.latest_resources`."""
    if jdbc:
        return spark.read.format("jdbc").options(**jdbc).load()
    return spark.read.parquet(path)


def parse_dictionary(documents: DataFrame, value: str = "value") -> DataFrame:
    """JSON objects of id to names, as rows of ``resource_pos, resource_id, names``."""
    parsed = F.from_json(value, "map<string,array<string>>")
    return documents.select(F.posexplode(parsed).alias("resource_pos", "resource_id", "names"))


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return parse_dictionary(spark.read.text(path, wholetext=True))


def read_extra_aliases(spark: SparkSession, path: str) -> DataFrame:
    rows = parse_dictionary(spark.read.text(path, wholetext=True))
    return rows.select(F.col("resource_id").alias("short_name"), F.col("names").alias("aliases"))


def read_definitions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path, schema=DEFINITION_SCHEMA, multiLine=True)


def read_core_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path, schema=CORE_SCHEMA, multiLine=True)


def read_metadata_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of metadata files (gzip or plain) with their place, for last-record-wins."""
    return spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )


def read_article_bundles(spark: SparkSession, path: str) -> DataFrame:
    """``pmcid, xml, bundle`` for each article of combined files; text that precedes an
    article's opening tag is cut off, articles without an id are dropped."""
    rows = spark.read.option("lineSep", ARTICLE_END).text(path)
    start = F.regexp_extract("value", r"(?s)(<article[\s>].*)$", 1)
    number = F.regexp_extract("value", ARTICLE_ID, 1)
    return rows.where(F.rlike("value", F.lit(r"<article[\s>]"))).select(
        F.concat(F.lit("PMC"), number).alias("pmcid"),
        F.concat(start, F.lit(ARTICLE_END)).alias("xml"),
        F.col("_metadata.file_name").alias("bundle"),
    ).where(F.col("pmcid") != "PMC")


def read_texts(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, text``, one file per article, the id is the file name."""
    return spark.read.text(folder, wholetext=True, pathGlobFilter="*.txt").select(
        F.regexp_replace("_metadata.file_name", r"\.txt$", "").alias("doc_id"),
        F.col("value").alias("text"),
    )


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed ids, blank lines dropped, with the file they came from."""
    return spark.read.text(path).select(
        strip(F.col("value")).alias("pmcid"), F.col("_metadata.file_name").alias("name")
    ).where(F.col("pmcid") != "")


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    """Labelled CSVs, quoted fields may hold commas, quotes and line breaks. Files with
    the older ``matched_term``/``matched_alias`` headers are read by position."""
    return spark.read.csv(
        path, schema=LABELLED_SCHEMA, header=True, multiLine=True, quote='"', escape='"',
        enforceSchema=True, recursiveFileLookup=True, pathGlobFilter="*.csv",
    )


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=SUMMARY_SCHEMA, header=True, quote='"', escape='"')


def read_counts(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def read_version(spark: SparkSession, path: str) -> dict:
    """The run version record: one small JSON object."""
    return spark.read.json(path, schema=VERSION_SCHEMA, multiLine=True).first().asDict()


def union_labelled(*frames: DataFrame) -> DataFrame:
    """All labelled examples; an empty set is an error before any training starts."""
    rows = frames[0]
    for frame in frames[1:]:
        rows = rows.unionByName(frame)
    if rows.isEmpty():
        raise ValueError("no labelled examples")
    return rows
