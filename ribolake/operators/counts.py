"""Counts at feature, taxon and category level, and summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .intervals import overlap_count
from .staging import stage


def long_form(df: DataFrame, categories: Mapping[str, Column], keys: Sequence[str] = ("sample",)) -> DataFrame:
    """One row per key and category, in one pass over ``df``."""
    rows = F.array(*[F.struct(F.lit(c).alias("category"), v.alias("value")) for c, v in categories.items()])
    return df.select(*keys, F.explode(rows).alias("_r")).select(*keys, "_r.category", "_r.value")


def multihit_count(hits: DataFrame) -> DataFrame:
    """Each hit with ``n_hits``, the number of hits of its sequence; hits that are counted already stay as they are."""
    if "n_hits" in hits.columns:
        return hits
    hits = stage(hits, "hits")
    return hits.join(hits.groupBy("seq").agg(F.count("*").alias("n_hits")), "seq").select(*hits.columns, "n_hits")


def hit_weights(hits: DataFrame, max_mismatches: int | None = None) -> DataFrame:
    """Share of a read given to each of its hits: one over the number of hits."""
    kept = hits if max_mismatches is None else hits.drop("n_hits").filter(F.col("mm") <= max_mismatches)
    return multihit_count(kept).withColumn("weight", 1.0 / F.col("n_hits"))


def density_weights(hits: DataFrame, distance: int = 50, max_mismatches: int | None = None, abundance: DataFrame | None = None) -> DataFrame:
    """Share of a read given to each of its hits by the unique hits around them.

    Two passes: sequences with one hit are counted by place, then a hit of the others
    weighs as many of them as start within ``distance`` bases of it on its strand, over the
    sum for all hits of its sequence; where that sum is zero, one over the number of hits.
    ``abundance`` (seq, n) counts reads instead of sequences. The range sums are differences
    of running sums over positions: no hit meets another.
    """
    kept = hits if max_mismatches is None else hits.drop("n_hits").filter(F.col("mm") <= max_mismatches)
    counted = stage(multihit_count(kept), "hits-counted")
    keys = [c for c in ("panel", "ref_id", "strand") if c in hits.columns]
    single = counted.filter("n_hits = 1")
    single = single.withColumn("_n", F.lit(1)) if abundance is None else single.join(
        abundance.groupBy("seq").agg(F.sum("n").alias("_n")), "seq"
    )
    unique = single.groupBy(*keys, F.col("pos").alias("start")).agg(F.sum("_n").alias("_n")).withColumn("end", F.col("start") + 1)
    places = counted.filter("n_hits > 1").select(
        *keys, (F.col("pos") - distance).alias("start"), (F.col("pos") + distance + 1).alias("end")
    ).distinct()
    near = overlap_count(places, unique, keys, "_near", "_n").select(*keys, (F.col("start") + distance).alias("pos"), "_near")
    rows = stage(counted.join(near, [*keys, "pos"], "left").withColumn("_near", F.coalesce("_near", F.lit(0))), "hits-near")
    sums = rows.groupBy("seq").agg(F.sum("_near").alias("_sum"))
    return rows.join(sums, "seq").withColumn(
        "weight", F.when(F.col("_sum") > 0, F.col("_near") / F.col("_sum")).otherwise(1.0 / F.col("n_hits"))
    ).select(*counted.columns, "weight")


def fractional_counts(collapsed: DataFrame, hits: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """Reads per sample and reference, and panel if hits have one; a read with h hits adds 1/h to each.

    Other ``weights`` are hits with a ``weight``, such as those of ``density_weights``.
    Hits of one sequence on one reference are added up before samples are joined in.
    """
    keys = [c for c in ("panel", "ref_id") if c in hits.columns]
    share = (hit_weights(hits) if weights is None else weights).groupBy("seq", *keys).agg(F.sum("weight").alias("share"))
    return collapsed.join(share, "seq").groupBy("sample", *keys).agg(
        F.sum(F.col("n") * F.col("share")).alias("reads")
    )


def reference_counts(collapsed: DataFrame, best_hits: DataFrame, keys: Sequence[str] = ("ref_id",)) -> DataFrame:
    """Reads per sample and reference from one best hit a sequence."""
    return collapsed.join(best_hits.select("seq", *keys), "seq").groupBy("sample", *keys).agg(
        F.sum("n").alias("reads")
    )


def level_counts(
    counts: DataFrame,
    dimensions: DataFrame,
    levels: Mapping[str, Sequence[str]],
    on: str = "ref_id",
    value: str = "reads",
) -> DataFrame:
    """Totals at several levels of a dimension table in one pass.

    ``counts`` is already one row per sample and reference, so the grouping sets
    multiply few rows. References without dimension count as ``unassigned``.
    """
    columns: list[str] = []
    for names in levels.values():
        columns += [c for c in names if c not in columns]
    per_reference = counts.groupBy("sample", on).agg(F.sum(value).alias(value))
    wide = per_reference.join(dimensions, on, "left").select(
        "sample", value, *[F.coalesce(F.col(c), F.lit("unassigned")).alias(c) for c in columns]
    )
    grouped = wide.groupingSets(
        [["sample", *names] for names in levels.values()], "sample", *columns
    ).agg(F.sum(value).alias(value), F.grouping_id().alias("_gid"))
    width = len(columns)
    label = None
    for level, names in levels.items():
        gid = sum(1 << (width - 1 - i) for i, c in enumerate(columns) if c not in names)
        label = F.when(F.col("_gid") == gid, level) if label is None else label.when(F.col("_gid") == gid, level)
    return grouped.select("sample", label.alias("level"), *columns, value)


# Levels of the transfer-RNA tables.
TRNA_LEVELS = {
    "feature": ("ref_id",),
    "phylum_class": ("phylum",),
    "species": ("species",),
    "amino_acid": ("aa",),
    "anticodon": ("anticodon",),
    "phylum_species": ("phylum", "species"),
}
# Levels of the family tables.
FAMILY_LEVELS = {
    "class": ("family_class",),
    "taxon": ("taxon",),
    "class_taxon": ("family_class", "taxon"),
    "family": ("family",),
    "accession": ("accession",),
}


def count_total(counts: DataFrame, keys: Sequence[str] = ("sample",), value: str = "reads") -> DataFrame:
    """Sum of a count table."""
    return counts.groupBy(*keys).agg(F.sum(value).alias("total"))


def feature_counts(annotated: DataFrame) -> DataFrame:
    """Raw and weighted reads per sample and feature; needs feature, n, weight."""
    return annotated.groupBy("sample", "feature", "ftype").agg(
        F.sum("n").alias("raw"), F.sum(F.col("n") * F.col("weight")).alias("weighted")
    )


def length_histogram(alignments: DataFrame, max_length: int = 51) -> DataFrame:
    """Weighted reads per length up to ``max_length``; needs start, end, n, weight."""
    size = (F.col("end") - F.col("start")).cast("bigint")
    return alignments.filter(size <= max_length).groupBy("sample", size.alias("length")).agg(
        F.sum(F.col("n") * F.col("weight")).alias("reads")
    )


def pipeline_summary(summaries: Mapping[str, DataFrame]) -> DataFrame:
    """Union of summaries (sample, category, value) with their source; values as text."""
    out = None
    for source, df in summaries.items():
        part = df.select(
            F.lit(source).alias("source"), "sample", "category", F.col("value").cast("string").alias("value")
        )
        out = part if out is None else out.unionByName(part)
    return out
