"""Tab-separated and whitespace tables: samples, hits, taxa, counts, summaries."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.samples import blank_to_null, check_samples


def read_sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Sample sheet with ``name`` and ``fastq``; optional columns are added where absent.

    Cells are trimmed, blank rows skipped; missing columns, incomplete rows, duplicate
    names and an empty sheet raise.
    """
    sheet = spark.read.csv(path, sep="\t", header=True, quote="", ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    missing = sorted({"name", "fastq"} - set(sheet.columns))
    if missing:
        raise ValueError(f"sample sheet lacks columns: {', '.join(missing)}")
    wanted = ["name", "type", "fastq", "assembly_fasta", "assembly_gff"]
    any_value = F.coalesce(*[blank_to_null(F.coalesce(F.trim(F.col(c)), F.lit(""))) for c in sheet.columns]).isNotNull()
    rows = sheet.filter(any_value).select(*[
        F.coalesce(F.trim(F.col(c)), F.lit("")).alias(c) if c in sheet.columns else F.lit("").alias(c) for c in wanted
    ])
    check_samples(rows)
    return rows


def read_family_hits(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Query ids of a whitespace hit table: third field, comments skipped."""
    fields = F.split(F.trim("value"), r"\s+")
    return (
        spark.read.text(path).filter((F.col("value") != "") & ~F.startswith("value", F.lit("#")))
        .select(fields.alias("f")).filter(F.size("f") >= 3).select(F.col("f")[2].alias("query"))
    )


def read_accession_taxa(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """accession, taxid and name (null where the file has two columns)."""
    fields = F.split("value", "\t")
    return spark.read.text(path).select(fields.alias("f")).filter(F.size("f") >= 2).select(
        F.col("f")[0].alias("accession"), F.try_to_number(F.col("f")[1], F.lit("999999999")).cast("int").alias("taxid"),
        F.get("f", F.lit(2)).alias("name"),
    ).filter("taxid is not null")


def existing_paths(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """The paths that Spark finds, in their order."""
    found = []
    for path in [paths] if isinstance(paths, str) else paths:
        try:
            spark.read.text(path)
            found.append(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return found


def _fields(spark: SparkSession, paths: list[str]) -> DataFrame:
    """source (file name) and fields ``f`` of all lines but the first of each file."""
    if not paths:
        return spark.createDataFrame([], "source string, f array<string>")
    # A separator that no line holds leaves the line whole; the reader drops each file's header.
    lines = spark.read.csv(paths, schema="line string", sep="\u0001", header=True, quote="", escape="", enforceSchema=True)
    return lines.select(F.col("_metadata.file_name").alias("source"), F.split(F.coalesce("line", F.lit("")), "\t").alias("f"))


def count_file_sums(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """source (file name) and total of the last fields of each count file with rows.

    Files may differ in their columns; the first line of each is its header, and fields
    that are no number add nothing.
    """
    last = F.try_element_at("f", F.lit(-1)).try_cast("double")
    rows = _fields(spark, [path] if isinstance(path, str) else path).filter(F.size("f") > 1)
    return rows.groupBy("source").agg(F.coalesce(F.sum(last), F.lit(0.0)).alias("total"))


def count_file_totals(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The sum over all count files: one row."""
    return count_file_sums(spark, path).agg(F.coalesce(F.sum("total"), F.lit(0.0)).alias("total"))


def read_summaries(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """source (file name), sample, category, value of summary files, values as text.

    The first line of each file is its header; paths that do not exist are skipped.
    """
    return _fields(spark, existing_paths(spark, path)).filter(F.size("f") >= 3).select(
        "source", F.col("f")[0].alias("sample"), F.col("f")[1].alias("category"), F.col("f")[2].alias("value")
    )
