"""SAM text to alignment columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def sam_records(lines: DataFrame) -> DataFrame:
    """Records of SAM lines (column ``value``) with at least eleven fields; headers dropped.

    Optional tags become a map from ``TAG:type`` to value.
    """
    f = F.col("f")
    tag = lambda x: F.struct(F.substring(x, 1, 4).alias("key"), F.substring(x, F.lit(6), F.length(x)).alias("value"))
    return (
        lines.filter(~F.startswith("value", F.lit("@")))
        .select(F.split("value", "\t").alias("f"))
        .filter(F.size("f") >= 11)
        .select(
            f[0].alias("qname"), f[1].cast("int").alias("flag"), f[2].alias("rname"), f[3].cast("bigint").alias("pos"),
            f[4].cast("int").alias("mapq"), f[5].alias("cigar"), f[9].alias("seq"), f[10].alias("qual"),
            F.map_from_entries(F.transform(F.slice("f", F.lit(12), F.size("f")), tag)).alias("tags"),
        )
    )


def read_sam(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return sam_records(spark.read.text(path))
