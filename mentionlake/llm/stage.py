"""Tables staged in the shared folder: they cut lineage and outlive executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mentionlake.session import run_folder

#: Word separators shared by the operators: space and the controls from tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"


def staged(df: DataFrame, folder: str, name: str) -> DataFrame:
    """``df`` written once under ``folder`` and read back with its own schema."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_folder(spark: SparkSession, label: str) -> str:
    return run_folder(spark, label)


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = "_" + name
    return name
