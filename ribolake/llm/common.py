"""Small things that several operators share."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ribolake.operators import staging
from ribolake.operators.staging import join_side, ship

__all__ = ["SPACE", "WORD", "bound", "count_words", "discard", "documents", "join_small", "ship", "source_key", "stage", "table", "text_of", "words"]

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once, with the session's codec."""
    return staging.stage(df, label, None)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def text_of(docs: DataFrame, column: str = "text") -> Column:
    """The text; a null text counts as empty."""
    return F.coalesce(docs[column], F.lit(""))


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def count_words(text: Column) -> Column:
    """Number of words: pieces between white space, less the empty ones at the two ends."""
    pieces = F.size(F.split(text, SPACE))
    ends = F.when(text.rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0) + F.when(
        text.rlike(r"[\x20\x09-\x0D]\z"), 1
    ).otherwise(0)
    return F.when(text.rlike(WORD), pieces - ends).otherwise(0).cast("bigint")


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` reads it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def source_key(column: Column) -> Column:
    """A key that is never null and sorts by code point, null last."""
    return F.when(column.isNull(), F.lit("b")).otherwise(F.concat(F.lit("a"), column))


def discard(written: DataFrame) -> None:
    """Delete a written table that nothing reads any more, and let Spark drop old shuffle files."""
    spark = written.sparkSession
    files = written.inputFiles()
    if files:
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0].rpartition("/")[0])
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    gc.collect()
    spark._jvm.System.gc()


def join_small(df: DataFrame, side: DataFrame, on: list[str], rows: int, row_bytes: int = 128, how: str = "inner", limit: int = 500_000) -> DataFrame:
    """Join a written side of ``rows`` rows: broadcast up to the size bound, sort-merge beyond it."""
    return df.join(join_side(side, rows, row_bytes, limit), on, how)
