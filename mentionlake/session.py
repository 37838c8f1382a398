"""Session settings and the shared scratch folder used by jobs that write."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("mentionlake")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "10000")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local master may fall back to a temporary folder; a cluster may not, since
    a machine-local path is lost with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="mentionlake-")


def run_folder(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the shared folder for one run of one job."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to a folder of its own and read back."""
    path = run_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark application, unless they
    find it by themselves (same folder or PYTHONPATH). For ``spark-submit`` pass it
    with ``--py-files`` instead; then this does nothing new."""
    root = Path(__file__).resolve().parent.parent
    context = spark.sparkContext
    seen = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if str(root) in map(os.path.realpath, filter(None, seen)) or getattr(context, "_mentionlake_shipped", False):
        return
    if not os.path.isdir(root / "mentionlake"):
        return
    archive = Path(tempfile.mkdtemp(prefix="mentionlake-")) / "mentionlake.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted((root / "mentionlake").rglob("*.py")):
            out.write(path, path.relative_to(root))
    context.addPyFile(str(archive))
    context._mentionlake_shipped = True
