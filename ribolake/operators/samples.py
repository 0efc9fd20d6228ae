"""Sample sheet rules."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: the sample type where neither row nor defaults give one.
DEFAULT_TYPE = "sRNA-Ext"


def blank_to_null(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))


def with_defaults(samples: DataFrame, defaults: Mapping[str, str] | None = None) -> DataFrame:
    """Fill blank fields; a blank cell counts as missing."""
    defaults = {"type": DEFAULT_TYPE, **(defaults or {})}
    return samples.withColumns({
        c: F.coalesce(blank_to_null(F.col(c)), F.lit(defaults.get(c))) for c in samples.columns if c != "name"
    })


def duplicate_names(samples: DataFrame) -> DataFrame:
    """Names that occur more than once."""
    return samples.groupBy("name").agg(F.count("*").alias("rows")).filter("rows > 1")


def select_samples(samples: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of the requested names; ``wanted`` has one column ``name``."""
    return samples.join(wanted.select("name").distinct(), "name", "left_semi").select(*samples.columns)


def missing_names(samples: DataFrame, wanted: DataFrame) -> DataFrame:
    """Requested names that no sample has."""
    return wanted.select("name").distinct().join(samples, "name", "left_anti")


def check_samples(samples: DataFrame, wanted: DataFrame | None = None) -> None:
    """Raise on duplicate or unknown names, or rows without name or input."""
    incomplete = samples.filter(blank_to_null(F.col("name")).isNull() | blank_to_null(F.col("fastq")).isNull())
    problems = [("row without name or fastq", incomplete), ("duplicate sample name", duplicate_names(samples))]
    if wanted is not None:
        problems.append(("requested sample not found", missing_names(samples, wanted)))
    for text, rows in problems:
        first = rows.select("name").limit(1).collect()
        if first:
            raise ValueError(f"{text}: {first[0]['name']}")
    if samples.isEmpty():
        raise ValueError("the sample table has no usable rows")
