"""The corpus pipeline: quality rules, near-dedup, decontamination, mixing, token files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mentionlake.llm import decontaminate, mixing, near_dups, quality, token_files
from mentionlake.llm.queries import table, tokenizer
from mentionlake.llm.stage import new_folder, staged


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return near_dups.keep_one(docs)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    return mixing.mix(docs)


def token_rows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Written and read back as token files: one row per document of the mix."""
    return token_files.token_digests(docs, tokenizer())


STAGES = [
    ("quality_rules", good_documents),
    ("near_dedup", distinct_documents),
    ("decontamination", clean_documents),
    ("mixing", mixed_documents),
    ("token_files", token_rows),
]

#: The near-dedup stage has no SQL form; the whole run is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents table; each is written and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = new_folder(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, folder, f"{k}-{name}")
    return docs
