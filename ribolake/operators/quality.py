"""Read quality profiles: the measures behind a per-file quality report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructType

from ..functions.sequence import count_of
from .staging import ship

BASES = "ACGTN"


def position_counts(reads: DataFrame) -> DataFrame:
    """sample, position, base, phred and their number ``n``, counted by batches of reads inside Arrow tasks.

    A base other than A, C, G, T, N is empty. Where ``qual`` ends before ``seq`` phred is -33, without ``qual`` it is null.
    """
    ship(reads.sparkSession)
    schema = StructType([reads.schema["sample"]]).add("position", IntegerType()).add("base", StringType())
    schema = schema.add("phred", IntegerType()).add("n", LongType())

    def counted(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            names = batch.column("sample").dictionary_encode()
            seqs, quals = ([t for t in batch.column(c).to_pylist()] for c in ("seq", "qual"))
            lengths = np.array([len(s or "") for s in seqs], np.int64)
            # As long as its sequence; no value stands for the end of the text but 0, and none but 1 for no text.
            quals = ["\x01" * n if q is None else q if len(q) == n else q[:n].ljust(n, "\x00") for q, n in zip(quals, lengths.tolist())]
            bases, marks = "".join(s or "" for s in seqs), "".join(quals)
            plain = bases.isascii() and marks.isascii()
            units = lambda text: np.frombuffer(text.encode() if plain else text.encode("utf-32-le"), np.uint8 if plain else np.uint32)
            width, kinds = 128 if plain else 1 << 21, len(BASES) + 1
            kind = np.full(width, len(BASES), np.int64)
            kind[[ord(b) for b in BASES]] = np.arange(len(BASES))
            own = names.indices.fill_null(len(names.dictionary)).to_numpy(zero_copy_only=False).astype(np.int64)
            position = np.arange(len(bases)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            longest = int(lengths.max(initial=0))
            key = ((np.repeat(own, lengths) * longest + position) * width + units(marks)) * kinds + kind[units(bases)]
            if (len(names.dictionary) + 1) * longest * width * kinds <= 1 << 22:
                counts = np.bincount(key)
                key = np.flatnonzero(counts)
                counts = counts[key]
            else:
                key, counts = np.unique(key, return_counts=True)
            place, mark = key // kinds // width, key // kinds % width
            sample = place // max(longest, 1)
            yield pa.RecordBatch.from_arrays([
                names.dictionary.take(pa.array(sample, mask=sample == len(names.dictionary))),
                pa.array((place % max(longest, 1) + 1).astype(np.int32)),
                pa.array([*BASES, ""]).take(pa.array(key % kinds)),
                pa.array((mark - 33).astype(np.int32), mask=mark == 1), pa.array(counts.astype(np.int64)),
            ], names=["sample", "position", "base", "phred", "n"])

    return reads.select("sample", "seq", "qual").mapInArrow(counted, schema)


def position_profile(reads: DataFrame, stage_name: str = "raw") -> DataFrame:
    """Per sample and base position: reads, mean quality, base counts.

    Bases are counted where the reads are; one row a position, base and quality and task is shuffled.
    """
    n = F.col("n")
    return position_counts(reads).groupBy("sample", "position").agg(
        F.sum(n).alias("reads"),
        F.round(F.sum(F.col("phred") * n) / F.sum(n), 6).alias("mean_quality"),
        *[F.sum(F.when(F.col("base") == b, n).otherwise(0)).alias(f"{b.lower()}_bases") for b in BASES],
    ).withColumn("stage", F.lit(stage_name))


def quality_quantiles(reads: DataFrame, stage_name: str = "raw") -> DataFrame:
    """Exact quartiles of quality per sample and base position, from counts per quality value.

    A quartile is the smallest value at or below which a quarter, half or three quarters
    of the bases lie. There are at most 94 values at a position.
    """
    counts = position_counts(reads).groupBy("sample", "position", "phred").agg(F.sum("n").alias("n"))
    place = Window.partitionBy("sample", "position")
    summed = counts.withColumn("upto", F.sum("n").over(place.orderBy("phred"))).withColumn("total", F.sum("n").over(place))
    reached = lambda quarters: F.min(F.when(4 * F.col("upto") >= quarters * F.col("total"), F.col("phred")))
    return summed.groupBy("sample", "position").agg(
        reached(1).alias("lower"), reached(2).alias("median"), reached(3).alias("upper")
    ).select(F.lit(stage_name).alias("stage"), "sample", "position", "lower", "median", "upper")


def gc_histogram(reads: DataFrame, stage_name: str = "raw") -> DataFrame:
    """Reads per whole GC percent, rounded down."""
    percent = F.floor(count_of(F.col("seq"), "GC") * 100 / F.length("seq")).cast("bigint")
    return reads.groupBy("sample", percent.alias("gc_percent")).agg(F.count("*").alias("reads")).withColumn(
        "stage", F.lit(stage_name)
    )


def read_lengths(reads: DataFrame, stage_name: str = "raw") -> DataFrame:
    """Reads per length."""
    return reads.groupBy("sample", F.length("seq").cast("bigint").alias("length")).agg(
        F.count("*").alias("reads")
    ).withColumn("stage", F.lit(stage_name))


def duplication(collapsed: DataFrame, stage_name: str = "raw") -> DataFrame:
    """Distinct sequences and reads per copy number, from collapsed reads."""
    return collapsed.groupBy("sample", F.col("n").alias("copies")).agg(
        F.count("*").alias("sequences"), F.sum("n").alias("reads")
    ).withColumn("stage", F.lit(stage_name))
