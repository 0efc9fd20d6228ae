"""k-mer based screens and taxonomic classification."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.sequence import has_ambiguous, normalise, revcomp
from .align import build_index, mismatch_join, panel_tiles, tile_seeds
from .kmers import fits, with_found, with_taxa
from .ranking import ranked
from .staging import join_side, stage

# Fixed value: mixed into packed m-mers before the smallest is chosen, so that runs of A are not chosen everywhere.
MINIMIZER_MASK = 0x1E3779B97F4A7C15
# Start positions of one piece of a sequence.
PIECE = 512


def common_prefix(a: Column, b: Column) -> Column:
    """Longest common beginning of two arrays."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x != y, F.lit(True))), True)
    shorter = F.least(F.size(a), F.size(b))
    return F.slice(a, 1, F.when(differs > 0, differs.cast("int") - 1).otherwise(shorter))


def canonical(kmer: Column) -> Column:
    """The smaller of a k-mer and its reverse complement: one key for both strands."""
    return F.least(kmer, revcomp(kmer))


def panel_kmers(panel: DataFrame, k: int, tile: int = 512) -> DataFrame:
    """Distinct canonical k-mers per reference (ref_id, seq)."""
    tiles = panel_tiles(panel, max(tile, k), k)
    return tile_seeds(tiles, k, max(tile, k), strands="plus").select(canonical(F.col("kmer")).alias("kmer"), "ref_id").distinct()


def kmer_lca_table(panel: DataFrame, taxonomy: DataFrame, k: int) -> DataFrame:
    """k-mer to lineage of the lowest common ancestor of all taxa that contain it.

    ``panel``: ref_id, seq, taxid. Arrays sort element by element, so the common
    beginning of the smallest and the largest lineage is common to all of them.
    """
    lineage = taxonomy.select("taxid", "lineage")
    taxa = panel.select("ref_id", "taxid").join(lineage, "taxid")
    return (
        panel_kmers(panel, k).join(taxa, "ref_id")
        .groupBy("kmer").agg(F.min("lineage").alias("a"), F.max("lineage").alias("b"))
        .select("kmer", common_prefix(F.col("a"), F.col("b")).alias("lineage"))
    )


def read_kmers(sequences: DataFrame, k: int) -> DataFrame:
    """All unambiguous canonical k-mers of each sequence."""
    text = normalise(F.col("seq"))
    both = sequences.filter(F.length("seq") >= k).select("seq", text.alias("_fwd"), revcomp(text).alias("_rev"))
    size, width = F.length("_fwd"), F.lit(k)
    # One pass over the read for each strand; a k-mer and its mirror are then cut out together.
    mirrored = lambda at: F.struct(
        F.substring("_fwd", at, width).alias("f"), F.substring("_rev", size - k + 2 - at, width).alias("r")
    )
    rows = both.select("seq", F.inline(F.transform(F.sequence(F.lit(1), size - k + 1), mirrored)))
    return rows.filter(~has_ambiguous(F.col("f"))).select("seq", F.least("f", "r").alias("kmer"))


def pieces(rows: DataFrame, text: Column, starts: Column, k: int) -> DataFrame:
    """``rows`` unfolded to the unambiguous stretches ``_piece`` of k bases or more of ``text`` (bytes).

    A stretch holds k-mers of at most ``PIECE`` start positions, from one of ``starts`` (from 1) on; every
    k-mer without an unknown base is in one stretch.
    """
    cut = rows.select("*", text.alias("_text"), F.explode(starts).alias("_at")).select(
        *rows.columns, F.substring("_text", F.col("_at").cast("int"), F.lit(PIECE + k - 1)).cast("string").alias("_cut")
    )
    return cut.select(*rows.columns, F.explode(F.split("_cut", "[^ACGT]+")).alias("_piece")).filter(F.length("_piece") >= k)


def minimizers(rows: DataFrame, k: int, m: int) -> DataFrame:
    """Each distinct minimizer of every ``_piece`` as a number, and how many of its k-mers it stands for.

    The minimizer of a k-mer is the m-mer in it, on either strand, whose number is the smallest once the
    mask is mixed in. It is chosen from the k-mer alone, so equal k-mers have equal ones everywhere.
    """
    if not 1 <= m <= min(k, 31):
        raise ValueError(f"minimizers of {m} bases: at least 1, at most 31 and the {k} of the k-mer")
    mask, width = F.lit(MINIMIZER_MASK % 4**m), k - m + 1
    kept = [c for c in rows.columns if c != "_piece"]
    # Bases as digits to base 4 on both strands, once a piece. These and the arrays below are used more than once
    # above them, so they stay columns of their own and are not computed again for each m-mer.
    both = rows.select(
        *kept, F.translate("_piece", "ACGT", "0123").alias("_fwd"), F.reverse(F.translate("_piece", "ACGT", "3210")).alias("_rev")
    )
    size = F.length("_fwd")
    number = lambda at: F.conv(
        F.least(F.substring("_fwd", at, F.lit(m)), F.substring("_rev", size - m + 2 - at, F.lit(m))), 4, 10
    ).cast("bigint").bitwiseXOR(mask)
    every = both.select(*kept, F.transform(F.sequence(F.lit(1), size - m + 1), number).alias("_every"))
    least = F.transform("_every", lambda x, i: F.array_min(F.slice("_every", i + 1, F.lit(width))))
    chosen = every.select(*kept, F.slice(least, F.lit(1), F.size("_every") - width + 1).alias("_least"))
    once = F.transform(
        F.array_distinct("_least"),
        lambda x: F.struct(x.bitwiseXOR(mask).alias("minimizer"), F.size(F.filter("_least", lambda y: y == x)).alias("n")),
    )
    return chosen.select(*kept, F.inline(once))


def minimizer_lca_table(panel: DataFrame, taxonomy: DataFrame, k: int = 35, m: int = 31) -> DataFrame:
    """Minimizer (a ``bigint``) to lineage of the lowest common ancestor of all taxa that contain it.

    ``panel``: ref_id, seq, taxid. Of k - m + 2 positions about two are kept, so the table is several
    times smaller than one of all k-mers. Minimizers that a stretch repeats are one row before the shuffle, and
    only the first and last place of its taxa in the order of lineages is aggregated, so partial sums are
    two numbers a minimizer. The common beginning of these two lineages is common to all between.
    References whose taxon is null or not in ``taxonomy`` are left out; of a taxon with two lineages both count.
    """
    places = stage(ranked(taxonomy.select("taxid", "lineage"), ["lineage", "taxid"], "place"), "lineages")
    side = join_side(places, places.count(), 256)
    tiles = panel_tiles(panel, PIECE, k)
    # Within the context the tile's own bases come after its left margin.
    begin = F.col("tile") * PIECE - F.col("context_start") + 1
    cut = pieces(tiles.select("ref_id", "context", begin.alias("_begin")), F.col("context"), F.array("_begin"), k)
    taxa = panel.select("ref_id", "taxid").join(side.select("taxid", "place"), "taxid").select("ref_id", "place")
    found = minimizers(cut.select("ref_id", "_piece"), k, m).join(taxa, "ref_id")
    ends = found.groupBy("minimizer").agg(F.min("place").alias("_first"), F.max("place").alias("_last"))
    named = lambda end: side.select(F.col("place").alias(end), F.col("lineage").alias(f"{end}_lineage"))
    return ends.join(named("_first"), "_first").join(named("_last"), "_last").select(
        "minimizer", common_prefix(F.col("_first_lineage"), F.col("_last_lineage")).alias("lineage")
    )


def _is_prefix(short: Column, long: Column) -> Column:
    return F.slice(long, 1, F.size(short)) == short


def classify(sequences: DataFrame, lca: DataFrame, k: int) -> DataFrame:
    """Taxon of each distinct sequence by its k-mers; 0 where none is known.

    Each taxon scores the k-mers on its path from the root; the best score wins and
    ties go to the common ancestor. The list per sequence holds one entry per distinct
    taxon among its own k-mers, so the read length bounds it.
    """
    return assign(sequences.select("seq").distinct(), lca, k)


def assign(rows: DataFrame, lca: DataFrame, k: int) -> DataFrame:
    """``rows`` with ``taxid`` and ``score`` of their ``seq`` by the rules of ``classify``.

    A table that every task can hold is searched where the rows are: nothing is shuffled or joined.
    """
    lca = stage(lca, "kmer-lca")
    known = lca.count()
    if fits(known, k):
        return with_taxa(rows, lca, k)
    unique = rows.select("seq").distinct()
    per_taxon = read_kmers(unique, k).join(join_side(lca, known, 8 * k), "kmer").groupBy("seq", "lineage").agg(
        F.count("*").alias("hits")
    )
    named = _best_taxa(unique.filter("seq is not null"), per_taxon)
    return rows.join(named, "seq", "left").select(*rows.columns, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("taxid", "score")])


def classify_by_minimizers(sequences: DataFrame, table: DataFrame, k: int = 35, m: int = 31) -> DataFrame:
    """Taxon of each distinct sequence; each of its k-mers counts for the taxon of its minimizer.

    The rules of ``classify``; ``table`` was made with the same ``k`` and ``m``. With ``m`` equal to ``k`` the
    result is that of ``classify``. A sequence asks once for each distinct minimizer of a stretch.
    """
    table = stage(table, "minimizer-lca")
    known = table.count()
    unique = sequences.select("seq").distinct()
    if fits(known, m):
        return with_taxa(unique, table, k, m, MINIMIZER_MASK % 4**m)
    side = join_side(table, known, 160)
    text = F.encode(normalise(F.col("seq")), "UTF-8")
    starts = F.sequence(F.lit(1), F.length("seq") - k + 1, F.lit(PIECE))
    asked = minimizers(pieces(unique.filter(F.length("seq") >= k), text, starts, k), k, m)
    per_taxon = asked.join(side, "minimizer").groupBy("seq", "lineage").agg(F.sum("n").alias("hits"))
    return _best_taxa(sequences, per_taxon)


def _best_taxa(sequences: DataFrame, per_taxon: DataFrame) -> DataFrame:
    """The taxon with the best path from the root for each sequence, from its hits per lineage."""
    listed = per_taxon.groupBy("seq").agg(F.collect_list(F.struct("lineage", "hits")).alias("taxa"))
    path_score = lambda t: F.aggregate(
        F.filter("taxa", lambda u: _is_prefix(u["lineage"], t["lineage"])), F.lit(0).cast("bigint"), lambda s, u: s + u["hits"]
    )
    scored = listed.select("seq", F.transform("taxa", lambda t: F.struct(path_score(t).alias("score"), t["lineage"].alias("lineage"))).alias("s"))
    best = scored.withColumn("score", F.array_max(F.transform("s", lambda x: x["score"]))).withColumn(
        "top", F.transform(F.filter("s", lambda x: x["score"] == F.col("score")), lambda x: x["lineage"])
    )
    found = best.select("seq", "score", common_prefix(F.array_min("top"), F.array_max("top")).alias("lineage"))
    return sequences.select("seq").distinct().join(found, "seq", "left").select(
        "seq",
        F.coalesce(F.try_element_at("lineage", F.lit(-1)), F.lit(0)).alias("taxid"),
        F.coalesce("score", F.lit(0)).alias("score"),
    )


def clade_report(assigned: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Reads per sample and taxon, assigned directly and within the whole clade.

    ``assigned``: sample, taxid, n. Counts are added per taxon before lineages unfold.
    """
    direct = assigned.groupBy("sample", "taxid").agg(F.sum("n").alias("n"))
    unfolded = direct.join(taxonomy.select("taxid", "lineage"), "taxid").select(
        "sample", F.col("taxid").alias("leaf"), "n", F.explode("lineage").alias("taxid")
    )
    clades = unfolded.groupBy("sample", "taxid").agg(
        F.sum("n").alias("clade_reads"),
        F.coalesce(F.sum(F.when(F.col("leaf") == F.col("taxid"), F.col("n"))), F.lit(0)).alias("direct_reads"),
    )
    named = clades.join(taxonomy.select("taxid", "rank", "name"), "taxid")
    none = direct.filter("taxid = 0").select(
        F.lit(0).alias("taxid"), "sample", F.col("n").alias("clade_reads"), F.col("n").alias("direct_reads"),
        F.lit("unclassified").alias("rank"), F.lit("unclassified").alias("name"),
    )
    return named.unionByName(none)


def screen_length(bases: int, chance: float = 0.01) -> int:
    """k at which a random k-mer is in a panel of ``bases`` with at most the given chance."""
    return max(12, math.ceil(math.log(max(2 * bases / chance, 4), 4)))


def rrna_screen(sequences: DataFrame, panel: DataFrame, k: int | None = None, min_share: float = 0.5) -> DataFrame:
    """Distinct sequences with the share of their k-mers found in the rRNA panel.

    A table-based screen in place of a trained model: ``is_rrna`` where the share
    reaches ``min_share``. ``k`` follows the panel's size unless it is given. Sequences
    shorter than ``k`` have share 1 if they occur in the panel, else 0.
    """
    if k is None:
        k = screen_length(panel.agg(F.sum(F.length("seq"))).first()[0] or 0)
    known = stage(panel_kmers(panel, k).select("kmer").distinct(), "rrna-kmers")
    rows, total = sequences.select("seq"), F.greatest(F.length("seq") - k + 1, F.lit(1))
    known_rows = known.count()
    if fits(known_rows, k):
        # Searched where the rows are; only one row a sequence meets its copies.
        counted = with_found(rows, known, k)
    else:
        unique = stage(rows.distinct(), "screened")
        found = read_kmers(unique, k).join(join_side(known, known_rows, k + 32), "kmer").groupBy("seq").agg(F.count("*").alias("found"))
        counted = unique.join(found, "seq", "left").withColumn("found", F.coalesce("found", F.lit(0)))
    short = rows.filter((F.length("seq") < k) & (F.length("seq") > 0))
    shortest = short.agg(F.min(F.length("seq"))).first()[0]
    if shortest:
        index = build_index(panel, min_length=shortest, max_length=k)
        # The index looks up seeds of some bases; shorter reads than that name no place.
        placed = mismatch_join(short.filter(F.length("seq") >= index.k), index, 0, "all", index.k).select("seq").distinct()
        counted = counted.join(placed.withColumn("_placed", F.lit(1)), "seq", "left").withColumn("found", F.coalesce("_placed", "found"))
    share = F.round(F.col("found") / total, 6).alias("share")
    return counted.select("seq", share).withColumn("is_rrna", F.col("share") >= min_share).distinct()
