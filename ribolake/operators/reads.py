"""Read-level projections and filters: trimming, quality, length, collapsing."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.sequence import count_of, kept_length, kept_length_with_errors, low_quality_bases, strip_gaps, without_adapter
from .kmers import BUCKETS, bucket_counts, kmer_counts
from .ranking import ranked
from .staging import join_side, stage


def length_filter(df: DataFrame, min_length: int = 15, max_length: int | None = 250) -> DataFrame:
    """Keep sequences within both limits, ends included."""
    size = F.length("seq")
    return df.filter(size >= min_length if max_length is None else size.between(min_length, max_length))


def trim_adapter(df: DataFrame, adapter: str, min_overlap: int = 4) -> DataFrame:
    """Cut the 3' adapter from ``seq`` and ``qual``."""
    # The one-element explode is a fence: without it every later filter would be pushed
    # below this projection and would repeat the pattern search for each of its uses.
    kept = F.explode(F.array(F.length(without_adapter(F.col("seq"), adapter, min_overlap)))).alias("_kept")
    cut = lambda c: F.substring(c, F.lit(1), F.col("_kept")).alias(c)
    return df.select("*", kept).select(*[cut(c) if c in ("seq", "qual") else c for c in df.columns])


def trim_adapter_with_errors(df: DataFrame, adapter: str, max_share: float = 0.1, min_overlap: int = 4) -> DataFrame:
    """Cut the 3' adapter where at most ``max_share`` of its compared bases are misread."""
    kept = F.explode(F.array(kept_length_with_errors(F.col("seq"), adapter, max_share, min_overlap))).alias("_kept")
    cut = lambda c: F.substring(c, F.lit(1), F.col("_kept")).alias(c)
    return df.select("*", kept).select(*[cut(c) if c in ("seq", "qual") else c for c in df.columns])


def detect_adapters(
    df: DataFrame, k: int = 12, min_insert: int = 15, min_share: float = 0.1, min_reads: int = 5, max_left: int = 40,
    min_steady: int = 10,
) -> DataFrame:
    """The 3' adapter of each sample that has one: sample, adapter, reads.

    Each distinct read counts once, so an abundant insert is no adapter. Among the k-mers
    that start at ``min_insert`` or later, the one in most distinct reads is an adapter's
    if at least ``min_reads`` and ``min_share`` of the sample's distinct reads hold it; it
    is extended to the left while one base stands there in four fifths of those reads, if
    they are ``min_steady`` or more. A sample without such a k-mer has no row.
    """
    unique = stage(df.select("sample", "seq").distinct(), "distinct-reads")
    totals = unique.groupBy("sample").agg(F.count("*").alias("_total"))
    # A k-mer is in no more reads than its bucket has places, so only the k-mers of buckets that reach both
    # limits are counted one by one; of a sample without such a bucket no read is looked at again.
    frequent = (F.col("n") >= min_reads) & (F.col("n") >= F.col("_total") * min_share)
    heavy = stage(
        bucket_counts(unique, k, min_insert).join(totals, "sample").filter(frequent).groupBy("sample")
        .agg(F.array_sort(F.collect_list("bucket")).alias("buckets")),
        "adapter-buckets",
    )
    counted = kmer_counts(unique.join(join_side(heavy, heavy.count(), 4 * BUCKETS), "sample"), k, min_insert)
    best = counted.groupBy("sample").agg(F.min(F.struct((-F.col("reads")).alias("_n"), "kmer")).alias("b"))
    chosen = stage(
        best.join(totals, "sample").select("sample", "b.kmer", (-F.col("b._n")).alias("reads"), "_total")
        .filter((F.col("reads") >= min_reads) & (F.col("reads") >= F.col("_total") * min_share)).drop("_total"),
        "adapter-kmers",
    )
    holding = unique.join(join_side(chosen, chosen.count(), 64), "sample").withColumn("_at", F.expr(f"locate(kmer, seq, {min_insert + 1})")).filter("_at > 0")
    left = holding.select("sample", F.explode(F.sequence(F.lit(1), F.least(F.col("_at") - 1, F.lit(max_left)))).alias("d"), "seq", "_at").select(
        "sample", "d", F.substring("seq", F.col("_at") - F.col("d"), F.lit(1)).alias("base")
    )
    steady = left.groupBy("sample", "d", "base").agg(F.count("*").alias("n")).join(chosen, "sample").filter((5 * F.col("n") >= 4 * F.col("reads")) & (F.col("reads") >= min_steady))
    # At most one base a place reaches four fifths; the run of places 1, 2, 3 ... is the extension.
    runs = steady.groupBy("sample").agg(F.array_sort(F.collect_list(F.struct("d", "base"))).alias("s"))
    before = F.transform(F.filter("s", lambda e, i: e["d"] == i + 1), lambda e: e["base"])
    return chosen.join(runs, "sample", "left").select(
        "sample", F.concat(F.coalesce(F.reverse(F.array_join(before, "")), F.lit("")), "kmer").alias("adapter"), "reads"
    )


def trim_detected(df: DataFrame, adapters: DataFrame, min_overlap: int = 4) -> DataFrame:
    """Cut each sample's own adapter; samples without one stay as they are."""
    adapters = stage(adapters.select("sample", F.col("adapter").alias("_adapter")), "adapters")
    found = df.join(join_side(adapters, adapters.count(), 128), "sample", "left")
    kept = F.explode(F.array(F.coalesce(kept_length(F.col("seq"), F.col("_adapter"), min_overlap), F.length("seq")))).alias("_kept")
    cut = lambda c: F.substring(c, F.lit(1), F.col("_kept")).alias(c)
    return found.select(*df.columns, kept).select(*[cut(c) if c in ("seq", "qual") else c for c in df.columns])


def quality_filter(df: DataFrame, low_percent: int = 40, max_n: int = 5) -> DataFrame:
    """Drop reads with too many bases below Phred 15 or too many N."""
    low = low_quality_bases(F.col("qual"))
    return df.filter(
        (low * 100 <= F.length("seq") * low_percent) & (count_of(F.col("seq"), "N") <= max_n)
    )


def without_gaps(df: DataFrame, min_length: int | None = None) -> DataFrame:
    """Strip gaps, then apply an optional lower length limit."""
    out = df.withColumn("seq", strip_gaps(F.col("seq")))
    return out if min_length is None else out.filter(F.length("seq") >= min_length)


def length_class(df: DataFrame, short: tuple[int, int] = (18, 26)) -> DataFrame:
    """Label sequences ``short``, ``long`` or ``too_short`` by length."""
    low, high = short
    size = F.length("seq")
    return df.withColumn(
        "length_class",
        F.when(size.between(low, high), "short").when(size > high, "long").otherwise("too_short"),
    )


def collapse(df: DataFrame, keys: tuple[str, ...] = ("sample",)) -> DataFrame:
    """Distinct sequences with their read count ``n``."""
    return df.groupBy(*keys, "seq").agg(F.count("*").alias("n"))


def collapse_ranked(df: DataFrame) -> DataFrame:
    """Collapsed sequences with ``rank`` by abundance per sample and id ``rank-n``."""
    out = ranked(collapse(df), [F.desc("n"), F.col("seq")], by="sample")
    return out.withColumn("collapsed_id", F.concat_ws("-", "rank", "n"))


def mean_length(df: DataFrame) -> DataFrame:
    """Mean sequence length per sample: one decimal, then cut to an integer."""
    return df.groupBy("sample").agg(
        F.floor(F.round(F.avg(F.length("seq")), 1)).cast("bigint").alias("mean_length")
    )
