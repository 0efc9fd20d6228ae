"""GFF3 annotation: text lines to interval tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Feature types that describe a whole contig.
CONTAINER_TYPES = ("region", "source")


def gff_lines(lines: DataFrame) -> DataFrame:
    """Fields of GFF lines (column ``value``): no blanks, no comments, at least eight fields."""
    fields = F.split("value", "\t")
    return (
        lines.filter((F.col("value") != "") & ~F.startswith("value", F.lit("#")))
        .select(fields.alias("f"))
        .filter(F.size("f") >= 8)
        .select(
            F.col("f")[0].alias("contig"), F.col("f")[1].alias("source"), F.col("f")[2].alias("ftype"),
            F.col("f")[3].cast("bigint").alias("first"), F.col("f")[4].cast("bigint").alias("last"),
            F.col("f")[5].alias("score"), F.col("f")[6].alias("strand"), F.col("f")[7].alias("phase"),
            F.coalesce(F.get("f", F.lit(8)), F.lit("")).alias("attributes"),
        )
    )


def read_gff(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return gff_lines(spark.read.text(path))


def gff_intervals(gff: DataFrame) -> DataFrame:
    """Half-open intervals without container types; reversed coordinates are swapped."""
    start = F.greatest(F.col("first") - 1, F.lit(0))
    return gff.filter(~F.col("ftype").isin(*CONTAINER_TYPES)).select(
        "contig", F.least(start, "last").alias("start"), F.greatest(start, "last").alias("end"),
        "ftype", F.lit(".").alias("score"), "strand",
    )


def gff_wide(gff: DataFrame) -> DataFrame:
    """All feature types, with source, phase and attributes after the six interval columns."""
    return gff.select(
        "contig", F.greatest(F.col("first") - 1, F.lit(0)).alias("start"), F.col("last").alias("end"),
        F.regexp_extract("attributes", "ID=([^;]*)", 1).alias("id"), "score", "strand", "source", "ftype", "phase", "attributes",
    )
