"""FASTA records as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_fasta(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(ref_id, description, seq) of plain or gzip FASTA.

    Records are cut at a ``>`` that begins a line, so one inside a header stays.
    """
    reader = spark.read.option("lineSep", "\n>")
    lines = reader.text(path).select(F.regexp_replace("value", "^>", "").alias("value")).filter(F.trim("value") != "")
    header = F.trim(F.substring_index("value", "\n", 1))
    body = F.when(F.contains("value", F.lit("\n")), F.substring(F.col("value"), F.instr("value", "\n") + 1, F.length("value"))).otherwise("")
    return lines.select(
        F.regexp_extract(header, r"^(\S+)", 1).alias("ref_id"),
        F.trim(F.regexp_replace(header, r"^\S+", "")).alias("description"),
        F.regexp_replace(body, r"\s", "").alias("seq"),
    )
