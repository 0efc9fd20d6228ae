"""Interval merge, overlap counts and overlap joins on half-open coordinates.

Positions are cut into tiles so that no task ever holds a whole contig: inside a
tile rows are first reduced to one per position, which bounds every window by the
tile width, and one row per tile carries the state across tile borders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.alignment import bed_end, bed_start, is_mapped, opposite, strand_of
from ..functions.sequence import revcomp
from .ranking import ranked
from .staging import stage

TILE = 65_536
STRANDED = ("contig", "strand")


def _tile(position: str, width: int) -> Column:
    return F.floor(F.col(position) / width).cast("bigint")


def _so_far(keys: Sequence[str], order: str):
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)


def _before(keys: Sequence[str], order: str):
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def alignments_to_intervals(sam: DataFrame) -> DataFrame:
    """SAM columns (qname, flag, rname, pos, seq) of mapped records as intervals."""
    extra = [c for c in sam.columns if c not in {"qname", "flag", "rname", "pos", "seq"}]
    return sam.filter(is_mapped(F.col("flag"))).select(
        *extra,
        F.col("rname").alias("contig"),
        bed_start(F.col("pos")).alias("start"),
        bed_end(F.col("pos"), F.col("seq")).alias("end"),
        F.col("qname").alias("name"),
        strand_of(F.col("flag")).alias("strand"),
    )


def sorted_intervals(df: DataFrame) -> DataFrame:
    """Total order by contig and start, range-partitioned."""
    return df.orderBy("contig", "start", "end", "strand", "name")


def merge_intervals(
    df: DataFrame,
    keys: Sequence[str] = STRANDED,
    gap: int = 10,
    weight: str | None = None,
    tile: int = TILE,
) -> DataFrame:
    """Merge intervals of equal ``keys`` that lie at most ``gap`` apart.

    Returns keys, start, end and ``support``, the number of merged intervals (or the
    sum of ``weight``). Touching intervals merge.
    """
    keys = list(keys)
    cell = [*keys, "tile"]
    starts = stage(
        df.groupBy(*keys, "start").agg(
            F.max("end").alias("end"),
            F.sum(F.col(weight) if weight else F.lit(1)).alias("support"),
        ).withColumn("tile", _tile("start", tile)),
        "merge-starts",
    )
    reach = starts.groupBy(*cell).agg(F.max("end").alias("_end"))
    reach = reach.select(*cell, F.max("_end").over(_before(keys, "tile")).alias("_reach"))
    heads = starts.join(reach, cell).withColumn(
        "_reach", F.greatest("_reach", F.max("end").over(_before(cell, "start")))
    ).withColumn("_head", F.when(F.col("_reach").isNull() | (F.col("start") > F.col("_reach") + gap), F.col("start")))
    # Islands as far as one tile shows them: rows before its first head continue an
    # island of an earlier tile, so they form one row without a head.
    local = stage(
        heads.withColumn("_head", F.max("_head").over(_so_far(cell, "start")))
        .groupBy(*cell, "_head").agg(F.max("end").alias("end"), F.sum("support").alias("support")),
        "merge-islands",
    )
    last = local.groupBy(*cell).agg(F.max("_head").alias("_last"))
    last = last.select(*cell, F.max("_last").over(_before(keys, "tile")).alias("_carried"))
    return (
        local.join(last, cell)
        .groupBy(*keys, F.coalesce("_head", "_carried").alias("start"))
        .agg(F.max("end").alias("end"), F.sum("support").alias("support"))
    )


def name_clusters(clusters: DataFrame, by: str | None = None) -> DataFrame:
    """``cluster_<i>``: plus strand first, then minus, each in coordinate order."""
    strand_rank = F.when(F.col("strand") == "+", 0).otherwise(1)
    numbered = ranked(clusters, [strand_rank, F.col("contig"), F.col("start")], name="_no", by=by)
    return numbered.withColumn("name", F.concat(F.lit("cluster_"), F.col("_no").cast("string"))).drop("_no")


def length_between(df: DataFrame, low: int, high: int) -> DataFrame:
    return df.filter((F.col("end") - F.col("start")).between(low, high))


def supported(df: DataFrame, min_reads: int = 10) -> DataFrame:
    return df.filter(F.col("support") >= min_reads)


def overlap_count(
    a: DataFrame,
    b: DataFrame,
    keys: Sequence[str] = STRANDED,
    name: str = "overlaps",
    weight: str | None = None,
    tile: int = TILE,
) -> DataFrame:
    """Number of ``b`` intervals that overlap each ``a`` interval of equal keys.

    No pair is formed. An interval overlaps [s, e) unless it starts at or after e or
    ends at or before s, so the count is (starts before e) - (ends up to s), read
    from two running sums over positions. Two empty intervals at one position do both
    and are counted once too often among the ends, so those are added again.
    """
    keys = list(keys)
    cell = [*keys, "tile"]
    amount = F.col(weight) if weight else F.lit(1)
    zero = F.lit(0)

    def points(df: DataFrame, position: str, opened: Column, closed: Column, empty: Column = zero) -> DataFrame:
        return df.select(*keys, F.col(position).alias("pos"), opened.alias("opened"), closed.alias("closed"), empty.alias("empty"))

    marks = stage(
        points(b, "start", amount, zero)
        .unionByName(points(b, "end", zero, amount, F.when(F.col("start") == F.col("end"), amount).otherwise(0)))
        .unionByName(points(a, "start", zero, zero))
        .unionByName(points(a, "end", zero, zero))
        .groupBy(*keys, "pos").agg(*[F.sum(c).alias(c) for c in ("opened", "closed", "empty")])
        .withColumn("tile", _tile("pos", tile)),
        "overlap-marks",
    )
    sums = marks.groupBy(*cell).agg(F.sum("opened").alias("_o"), F.sum("closed").alias("_c"))
    earlier = _before(keys, "tile")
    sums = sums.select(
        *cell,
        F.coalesce(F.sum("_o").over(earlier), F.lit(0)).alias("_o"),
        F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_c"),
    )
    running = marks.join(sums, cell).select(
        *keys, "pos",
        (F.col("_o") + F.sum("opened").over(_so_far(cell, "pos")) - F.col("opened")).alias("_opened"),
        (F.col("_c") + F.sum("closed").over(_so_far(cell, "pos"))).alias("_closed"), F.col("empty").alias("_empty"),
    )
    before_end = running.select(*keys, F.col("pos").alias("end"), "_opened")
    up_to_start = running.select(*keys, F.col("pos").alias("start"), "_closed", "_empty")
    again = F.when(F.col("start") == F.col("end"), F.col("_empty")).otherwise(0)
    return (
        a.join(before_end, [*keys, "end"], "left").join(up_to_start, [*keys, "start"], "left")
        .withColumn(name, F.coalesce(F.col("_opened") - F.col("_closed") + again, F.lit(0)).cast("bigint"))
        .select(*a.columns, name)
    )


def without_overlap(a: DataFrame, b: DataFrame, keys: Sequence[str] = STRANDED) -> DataFrame:
    """Rows of ``a`` that no ``b`` interval of equal keys overlaps."""
    return overlap_count(a, b, keys, "_hits").filter("_hits = 0").drop("_hits")


def with_overlap(a: DataFrame, b: DataFrame, keys: Sequence[str] = STRANDED) -> DataFrame:
    """Rows of ``a`` that at least one ``b`` interval of equal keys overlaps, once each."""
    return overlap_count(a, b, keys, "_hits").filter("_hits > 0").drop("_hits")


BIN_STEPS = 8  # each level's bins are 8 times as wide as those below
BIN_LEVELS = 10


def _leveled(df: DataFrame, width: int) -> DataFrame:
    """Add the finest level whose bins are as wide as the interval is long."""
    size = F.greatest(F.col("end") - F.col("start"), F.lit(1))
    level = F.lit(0)
    for n in range(BIN_LEVELS):
        level = F.when(size > width * BIN_STEPS**n, n + 1).otherwise(level)
    return df.withColumn("_level", level)


def _in_bins(df: DataFrame, width: int) -> DataFrame:
    """Bins of the given level that an interval touches, at most a few."""
    wide = F.lit(width) * F.pow(F.lit(BIN_STEPS), F.col("_level")).cast("bigint")
    first, last = F.floor(F.col("start") / wide), F.floor((F.col("end") - 1) / wide)
    return df.withColumn("_first", first).withColumn("_bin", F.explode(F.sequence(first, F.greatest(first, last))))


def overlap_pairs(
    a: DataFrame,
    b: DataFrame,
    keys: Sequence[str] = STRANDED,
    bin_width: int = 512,
    prefix: str = "b_",
) -> DataFrame:
    """All overlapping pairs of equal keys; ``b`` columns get ``prefix``, plus ``overlap``.

    Intervals lie in bins as wide as themselves, of one of a few levels, so a long one
    touches no more bins than a short one. Two intervals meet at the level of the longer
    one: one join has the longer ``a`` (or equal levels), one the longer ``b``, and the
    shorter side is put into the bins of all levels that the longer side has. A pair
    counts only in the later of its two first bins, so it appears once.
    """
    left, right = _leveled(a, bin_width), _leveled(b, bin_width)
    renamed = [F.col(c).alias(c if c in {"_bin", "_level", *keys} else prefix + c) for c in [*b.columns, "_level", "_bin", "_first"]]
    s, e = F.greatest("start", prefix + "start"), F.least("end", prefix + "end")
    kept = [*a.columns, *(prefix + c for c in b.columns if c not in keys)]

    def raised(df: DataFrame, levels: list[int], strictly: bool) -> DataFrame:
        above = F.filter(F.array(*[F.lit(n) for n in levels]), lambda n: n > F.col("_own") if strictly else n >= F.col("_own"))
        return df.withColumnRenamed("_level", "_own").withColumn("_level", F.explode(above)).drop("_own")

    def met(x: DataFrame, y: DataFrame) -> DataFrame:
        joined = _in_bins(x, bin_width).join(_in_bins(y, bin_width).select(*renamed), [*keys, "_level", "_bin"])
        return joined.filter(
            (F.col("start") < F.col(prefix + "end"))
            & (F.col(prefix + "start") < F.col("end"))
            & (F.col("_bin") == F.greatest("_first", prefix + "_first"))
        ).select(*kept, (e - s).alias("overlap"))

    levels = lambda df: sorted(r[0] for r in df.select("_level").distinct().collect())  # a few numbers
    of_left, of_right = levels(left), levels(right)
    out = met(left, raised(right, of_left or [0], False))
    if any(n > of_left[0] for n in of_right) if of_left else False:
        out = out.unionByName(met(raised(left, of_right, True), right))
    return out


def overlap_left_outer(
    a: DataFrame, b: DataFrame, keys: Sequence[str] = ("contig",), bin_width: int = 512, prefix: str = "b_"
) -> DataFrame:
    """Overlap pairs, and rows of ``a`` without any as ``.``/-1 with overlap 0."""
    pairs = overlap_pairs(a, b, keys, bin_width, prefix)
    lonely = without_overlap(a, b, keys)
    fill = {
        prefix + f.name: F.lit(".") if f.dataType.typeName() == "string" else F.lit(-1).cast(f.dataType)
        for f in b.schema.fields if f.name not in keys
    }
    return pairs.unionByName(lonely.withColumns({**fill, "overlap": F.lit(0).cast("bigint")}))


def intergenic(clusters: DataFrame, annotation: DataFrame) -> DataFrame:
    """Clusters free of any annotation on their own strand."""
    return without_overlap(clusters, annotation)


def _mirrored(annotation: DataFrame) -> DataFrame:
    return annotation.withColumn("strand", opposite(F.col("strand"))).filter(F.col("strand").isNotNull())


def antisense_pairs(clusters: DataFrame, cds: DataFrame, bin_width: int = 512) -> DataFrame:
    """Clusters with each coding feature they overlap on the other strand."""
    return overlap_pairs(clusters, _mirrored(cds), STRANDED, bin_width).withColumn(
        "b_strand", opposite(F.col("strand"))
    )


def antisense(clusters: DataFrame, cds: DataFrame) -> DataFrame:
    """Clusters that overlap a coding feature on the other strand, once each, without support."""
    return with_overlap(clusters, _mirrored(cds)).drop("support").distinct()


def candidates(intergenic_rows: DataFrame, antisense_rows: DataFrame) -> DataFrame:
    """Both candidate sets in one table; a cluster may occur in both."""
    columns = antisense_rows.columns
    return intergenic_rows.select(*columns, F.lit("intergenic").alias("kind")).unionByName(
        antisense_rows.select(*columns, F.lit("antisense").alias("kind"))
    )


def extract_sequences(regions: DataFrame, contigs: DataFrame, chunk: int = 4096) -> DataFrame:
    """Strand-aware subsequence of each region, named ``contig:start-end(strand)``.

    Contigs (contig, seq) are cut into chunks first, so only the chunks a region
    touches travel to it and no row of the join carries a chromosome. Contigs that were read as
    tiles of ``chunk`` bases (contig, tile, seq) are joined as they are.
    """
    if "tile" in contigs.columns:
        pieces = contigs.select("contig", F.col("tile").cast("int").alias("_chunk"), F.col("seq").alias("_text"))
        ends = contigs.groupBy("contig").agg(F.sum(F.length("seq")).alias("_size"))
    else:
        pieces = contigs.select(
            "contig", F.posexplode(F.regexp_extract_all("seq", F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))).alias("_chunk", "_text")
        )
        ends = contigs.select("contig", F.length("seq").cast("bigint").alias("_size"))
    inside = regions.join(ends, "contig").filter((F.col("start") >= 0) & (F.col("end") <= F.col("_size"))).drop("_size")
    asked = inside.select("contig", "start", "end", "strand").distinct()
    asked = asked.withColumn(
        "_chunk",
        F.explode(F.sequence(F.floor(F.col("start") / chunk).cast("int"), F.floor((F.col("end") - 1) / chunk).cast("int"))),
    )
    base = F.col("_chunk").cast("bigint") * chunk
    low = F.greatest(F.col("start") - base, F.lit(0)).cast("int")
    high = F.least(F.col("end") - base, F.lit(chunk)).cast("int")
    parts = asked.join(pieces, ["contig", "_chunk"]).select(
        "contig", "start", "end", "strand", "_chunk", F.substring("_text", low + 1, high - low).alias("_text")
    )
    # At most region length / chunk pieces a region.
    glued = parts.groupBy("contig", "start", "end", "strand").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_chunk", "_text"))), lambda p: p["_text"]), "").alias("_seq")
    )
    named = glued.withColumns({
        "seq": F.when(F.col("strand") == "-", revcomp(F.col("_seq"))).otherwise(F.col("_seq")),
        "fasta_id": F.format_string("%s:%d-%d(%s)", "contig", "start", "end", "strand"),
    }).drop("_seq")
    return inside.join(named, ["contig", "start", "end", "strand"]).select(*regions.columns, "fasta_id", "seq")


def without_family_hit(sequences: DataFrame, hits: DataFrame | None, id_column: str = "fasta_id") -> DataFrame:
    """Drop sequences whose id is in the hit table; without a table all pass."""
    if hits is None:
        return sequences
    return sequences.join(hits.select(F.col("query").alias(id_column)).distinct(), id_column, "left_anti")


def novel_clusters(
    alignments: DataFrame,
    gap: int = 10,
    min_length: int = 18,
    max_length: int = 250,
    min_reads: int = 10,
    tile: int = TILE,
) -> DataFrame:
    """Alignment intervals to supported, named clusters per sample.

    The islands of a merge are disjoint, so an alignment overlaps its own island and
    no other: the support comes out of the merge itself, without a second join.
    """
    merged = merge_intervals(alignments, ("sample", *STRANDED), gap, tile=tile)
    named = name_clusters(merged, by="sample")
    return supported(length_between(named, min_length, max_length), min_reads)


def best_annotation(pairs: DataFrame, alignment_key: Sequence[str]) -> DataFrame:
    """Per alignment the annotation with the largest overlap, ties by start then name.

    ``min`` over a struct aggregates map-side, so no group is sorted or collected.
    """
    order = F.struct((-F.col("overlap")).alias("o"), F.col("b_start"), F.col("b_end"), F.col("b_name"), F.col("b_ftype"))
    return pairs.groupBy(*alignment_key).agg(F.min(order).alias("_b")).select(
        *alignment_key,
        F.col("_b.b_name").alias("feature"),
        F.col("_b.b_ftype").alias("ftype"),
        (-F.col("_b.o")).alias("overlap"),
    )
