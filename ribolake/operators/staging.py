"""Written intermediate tables and size-checked joins.

A table that several branches read is written once, as Parquet, to the shared
folder the cluster names in ``spark.checkpoint.dir``. It survives lost executors,
ends the lineage, and gives the planner true sizes.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

# Largest side that is sent to every executor, by rows and by bytes of its widest use.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
# With this setting Spark deletes the shuffle files of a finished execution; else they stay until the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@lru_cache(maxsize=None)
def _local_folder(app_id: str) -> str:
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def staging_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; only a local session may fall back to /tmp."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder(spark.sparkContext.applicationId)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile leaves no shuffle files; a plan that runs again makes them again."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def stage(df: DataFrame, label: str, codec: str | None = "zstd") -> DataFrame:
    """Write ``df`` once and return it as a table read back from storage; without ``codec`` with the session's."""
    spark = df.sparkSession
    path = f"{staging_folder(spark)}/{label}-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_side(df: DataFrame, rows: int, row_bytes: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a side whose row count is known: broadcast if small, else sort-merge.

    Without the hint the planner would size an exploded table by its input file and
    might broadcast something many times larger than its threshold.
    """
    if rows <= limit and rows * row_bytes <= BROADCAST_BYTES:
        return F.broadcast(df)
    return df.hint("merge")


@lru_cache(maxsize=None)
def _shipped(application: str, spark: SparkSession) -> None:
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(path))


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once an application; called before Python runs in tasks.

    Spark itself copies the archive to the executors; nothing reads the driver's file.
    """
    _shipped(spark.sparkContext.applicationId, spark)
