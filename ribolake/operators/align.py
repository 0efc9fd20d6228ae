"""Mismatch-tolerant join of read sequences to reference panels.

A read with at most v substitutions, cut into p disjoint pieces, has one piece with
at most v // p of them. Each read therefore asks an index of reference k-mers for
its pieces. Reads too short for v + 1 pieces ask for the neighbourhood of theirs with
one mismatch; with more they are cut into v + 3 short pieces, of which three are exact:
every three of them, with their distances, are a spaced key, looked up in a table of such
keys of the references. Every answer is verified against the reference window. All
steps are joins and column expressions; nothing is capped. Large references are searched in buckets
inside Arrow tasks, with one mismatch by ``nearby`` and with more by ``classes``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.sequence import has_ambiguous, mismatches_up_to, normalise, revcomp
from . import classes
from .counts import multihit_count
from .nearby import PREFIX, SEED, SHORTEST, WIDEST, WIDTH, near_hits, packed, plain
from .staging import BROADCAST_BYTES, BROADCAST_ROWS, join_side, stage

# References with more k-mers are searched by long seeds and in buckets; of smaller ones a seed occurs rarely.
LARGE_ROWS = 100_000
HIT_COLUMNS = ("seq", "ref_id", "pos", "strand", "mm")
# A reference is named by its panel and its id in it; tables without panels have one.
REFERENCE = ("panel", "ref_id")


@dataclass(frozen=True)
class PanelIndex:
    """Seeds and context tiles of a panel, both written tables.

    A seed is a k-mer of the references or its reverse complement, whichever is smaller,
    as a number of two bits a base. ``side`` is 1 where the reference holds it as it is,
    -1 where it holds the reverse complement, 0 where both are the same.
    """

    seeds: DataFrame
    tiles: DataFrame
    k: int
    max_length: int
    tile: int
    seed_rows: int
    tile_rows: int
    has_panel: bool = False
    strands: str = "both"
    written: bool = True
    spaced: dict[tuple[int, int], tuple[DataFrame, int]] = field(default_factory=dict)  # built on first use
    sieves: dict[tuple[int, int], DataFrame] = field(default_factory=dict)  # built on first use
    windows: dict[int, DataFrame] = field(default_factory=dict)  # blocks of the last search, by bases looked up; not written
    longer: dict[int, DataFrame] = field(default_factory=dict)  # the same of long seeds
    reseeded: dict[int, PanelIndex] = field(default_factory=dict)  # built on first use
    numbered: dict[str, DataFrame] = field(default_factory=dict)  # built on first use


def with_panel(references: DataFrame) -> DataFrame:
    """References with a ``panel``: their own, or an empty name."""
    return references if "panel" in references.columns else references.withColumn("panel", F.lit(""))


def check_references(references: DataFrame) -> None:
    """Raise where a panel names two references alike."""
    twice = references.groupBy(*REFERENCE).count().filter("count > 1").orderBy(*REFERENCE).first()
    if twice:
        raise ValueError(f"reference {twice['ref_id']!r} occurs {twice['count']} times in panel {twice['panel']!r}")


def panel_tiles(panel: DataFrame, tile: int, margin: int) -> DataFrame:
    """Cut each reference into tiles with ``margin`` bases of context on both sides.

    References read as tiles of ``tile`` bases (ref_id, tile, seq, without gaps) get their context from their neighbours.
    """
    if "tile" in panel.columns:
        return _with_context(panel, tile, margin)
    text = F.translate(normalise(F.col("seq")), "-. \t", "")
    parts = with_panel(panel).select(*REFERENCE, text.alias("_seq")).filter("length(_seq) > 0").select(
        *REFERENCE,
        F.length("_seq").cast("bigint").alias("ref_len"),
        F.regexp_extract_all("_seq", F.lit(f".{{1,{tile}}}"), F.lit(0)).alias("_parts"),
    )
    tiles = F.transform(
        F.col("_parts"),
        lambda part, i: F.struct(
            i.cast("bigint").alias("tile"),
            F.when(i > 0, F.right(F.get(F.col("_parts"), i - 1), F.lit(margin))).otherwise("").alias("left"),
            part.alias("mid"),
            F.coalesce(F.substring(F.get(F.col("_parts"), i + 1), 1, margin), F.lit("")).alias("right"),
        ),
    )
    return parts.select(*REFERENCE, "ref_len", F.explode(tiles).alias("t")).select(
        *REFERENCE, "ref_len", F.col("t.tile").alias("tile"),
        (F.col("t.tile") * tile - F.length("t.left")).alias("context_start"),
        # As bytes: a slice of a binary value costs its own length, a substring of text
        # is sought from the beginning.
        F.encode(F.concat("t.left", "t.mid", "t.right"), "UTF-8").alias("context"),
    )


def _with_context(tiles: DataFrame, tile: int, margin: int) -> DataFrame:
    """Tiles with the ends of their neighbours: each tile is sent to itself, and its ends to the tiles beside it."""
    if margin > tile:
        raise ValueError(f"tiles of {tile} bases are shorter than the context of {margin}")
    text, at = normalise(F.col("seq")), F.col("tile").cast("bigint")
    sent = F.array(
        F.struct(at.alias("tile"), F.lit("mid").alias("part"), text.alias("text")),
        F.struct((at + 1).alias("tile"), F.lit("left").alias("part"), F.right(text, F.lit(margin)).alias("text")),
        F.struct((at - 1).alias("tile"), F.lit("right").alias("part"), F.substring(text, 1, margin).alias("text")),
    )
    part = lambda name: F.max(F.when(F.col("part") == name, F.col("text")))
    joined = (
        with_panel(tiles).filter(F.length("seq") > 0).select(*REFERENCE, F.inline(sent)).groupBy(*REFERENCE, "tile")
        .agg(part("left").alias("_left"), part("mid").alias("_mid"), part("right").alias("_right"))
        .filter("_mid is not null")
    )
    sizes = with_panel(tiles).groupBy(*REFERENCE).agg(F.sum(F.length("seq")).alias("ref_len"))
    return joined.join(sizes, list(REFERENCE)).select(
        *REFERENCE, "ref_len", "tile", (F.col("tile") * tile - F.coalesce(F.length("_left"), F.lit(0))).alias("context_start"),
        F.encode(F.concat(F.coalesce("_left", F.lit("")), "_mid", F.coalesce("_right", F.lit(""))), "UTF-8").alias("context"),
    )


def tile_seeds(tiles: DataFrame, k: int, tile: int, strands: str = "both") -> DataFrame:
    """k-mers that start inside each tile: (kmer, panel, ref_id, tile, at, strand)."""
    begin = F.col("tile") * tile
    end = F.least(begin + tile, F.col("ref_len") - k + 1)
    rows = tiles.filter(end > begin).select(
        *REFERENCE, "tile", "context", "context_start", F.explode(F.sequence(begin, end - 1)).alias("at")
    ).select(
        *REFERENCE, "tile", "at",
        F.substring("context", (F.col("at") - F.col("context_start") + 1).cast("int"), F.lit(k)).cast("string").alias("kmer"),
    ).filter(~has_ambiguous(F.col("kmer")))
    sides = [F.struct(F.lit("+").alias("strand"), F.col("kmer").alias("kmer"))]
    if strands == "both":
        sides.append(F.struct(F.lit("-").alias("strand"), revcomp(F.col("kmer")).alias("kmer")))
    return rows.select(*REFERENCE, "tile", "at", F.explode(F.array(*sides)).alias("s")).select(
        F.col("s.kmer").alias("kmer"), *REFERENCE, "tile", "at", F.col("s.strand").alias("strand")
    )


def canonical_seed(kmer: Column) -> tuple[Column, Column]:
    """Number of the smaller of a k-mer and its reverse complement, and which of the two it is."""
    mirror = revcomp(kmer)
    return packed(F.least(kmer, mirror)), F.when(kmer < mirror, 1).when(kmer > mirror, -1).otherwise(0)


def packed_seeds(tiles: DataFrame, k: int, tile: int) -> DataFrame:
    """One canonical seed for every k-mer that starts inside a tile: (kmer, panel, ref_id, tile, at, side)."""
    number, side = canonical_seed(F.col("kmer"))
    return tile_seeds(tiles, k, tile, "plus").select(number.alias("kmer"), *REFERENCE, "tile", "at", side.cast("tinyint").alias("side"))


def seed_matches(probes: DataFrame, index: PanelIndex, broadcast_rows: int) -> DataFrame:
    """``probes`` (with a text ``kmer``) and the places of their k-mers: panel, ref_id, tile, at and strand."""
    number, side = canonical_seed(F.col("kmer"))
    asked = probes.withColumn("_side", side).withColumn("kmer", number)
    seeds = join_side(written_seeds(index), index.seed_rows, 96, broadcast_rows)
    strand = F.when(F.col("side") == 0, F.array(F.lit("+"), F.lit("-"))).otherwise(
        F.array(F.when(F.col("side") == F.col("_side"), "+").otherwise("-"))
    )
    found = asked.join(seeds, "kmer").withColumn("strand", F.explode(strand)).drop("kmer", "side", "_side")
    return found if index.strands == "both" else found.filter("strand = '+'")


def seed_length(bases: int, min_length: int) -> int:
    """Seed length at which a random seed occurs about once on both strands of the panel."""
    return max(7, min(min_length, math.ceil(math.log(max(2 * bases, 4), 4))))


def build_index(
    panel: DataFrame,
    k: int | None = None,
    min_length: int = 15,
    max_length: int = 250,
    strands: str = "both",
    tile: int = 512,
) -> PanelIndex:
    """Index references (ref_id, seq and, for several panels, panel) once for any number of joins.

    An id may occur in several panels but only once in each; with panels, hits carry the
    panel they are on. References may come as tiles (ref_id, tile, seq) of exactly ``tile`` bases, as
    ``read_fasta_tiles`` gives them; then no row holds a whole one. ``k`` defaults to a length that fits the panel's size; it may not exceed the
    shortest sequence that will be aligned.
    """
    tiled = "tile" in panel.columns
    if not tiled:
        tile = max(tile, max_length)
    check_references(with_panel(panel.filter("tile = 0") if tiled else panel))
    tiles = stage(panel_tiles(panel, tile, max_length), "tiles")
    # A tile's own bases, without its margins.
    own = F.least(F.lit(tile), F.col("ref_len") - F.col("tile") * tile)
    size = tiles.agg(F.sum(own).alias("bases"), F.count("*").alias("rows")).first()
    k = k or seed_length(size["bases"] or 0, min_length)
    seeds = packed_seeds(tiles, k, tile)
    # Those of large references are many and most searches there need none: they are written when one does.
    written = (size["bases"] or 0) <= LARGE_ROWS
    seeds = stage(seeds, "seeds") if written else seeds
    return PanelIndex(seeds, tiles, k, max_length, tile, seeds.count(), size["rows"], "panel" in panel.columns, strands, written)


def written_seeds(index: PanelIndex) -> DataFrame:
    """The index's seeds as a written table."""
    return index.seeds if index.written else numbered(index, "seeds", lambda: index.seeds)


def _edit_list(k: int, wanted: bool) -> Column:
    """Single-base replacements (at, base) and, first, the one that changes nothing."""
    places = [(0, "")] + ([(i, base) for i in range(1, k + 1) for base in "ACGT"] if wanted else [])
    return F.array(*[F.struct(F.lit(i).alias("at"), F.lit(base).alias("base")) for i, base in places])


def _edited(rows: DataFrame, k: int, radius: Column, step: int, after: Column) -> DataFrame:
    """Unfold ``kmer`` by one replacement right of ``after`` where ``radius`` allows it."""
    choice = F.when(radius >= step, _edit_list(k, True)).otherwise(_edit_list(k, False))
    name = f"_edit{step}"
    rows = rows.select("*", F.explode(choice).alias(name))
    at, base = F.col(f"{name}.at"), F.col(f"{name}.base")
    changes = (at > after) & (F.substring("kmer", at, F.lit(1)) != base)
    return rows.filter((at == 0) | changes).withColumn(
        "kmer", F.when(at > 0, F.overlay("kmer", base, at)).otherwise(F.col("kmer"))
    )


def _within(min_length: int, max_length: int, value: Column) -> Column:
    """``value`` where the read's length is within the limits; else an error, never a silent miss."""
    outside = F.concat(F.lit(f"sequence length not within {min_length}..{max_length}: "), F.col("seq"))
    return F.when(F.length("seq").between(min_length, max_length), value.cast("int")).otherwise(F.raise_error(outside).cast("int"))


def read_probes(reads: DataFrame, k: int, v: int, min_length: int, max_length: int) -> DataFrame:
    """The k-mers each sequence asks for, in upper case and as DNA, with piece number and offset.

    With more than one mismatch, sequences shorter than ``v + 1`` pieces are left out:
    they ask for spaced keys.
    """
    size = F.length("seq")
    widest = v // min(min_length // k, v + 1) if v == 1 else 0
    pieces = _within(min_length, max_length, F.least(F.floor(size / k), F.lit(v + 1)))

    def cut(piece: Column) -> Column:
        offset = (piece * F.floor(size / F.col("pieces"))).cast("int")
        return F.struct(
            piece.alias("piece"), offset.alias("offset"),
            F.substring(normalise(F.col("seq")), offset + 1, F.lit(k)).alias("kmer"),
        )

    # Unfolding structs (not positions) makes each piece a computed column, so the
    # many replacements below do not cut it out of the read again.
    rows = reads.select("seq", pieces.alias("pieces"))
    if v > 1:
        rows = rows.filter(F.col("pieces") > v)
    rows = rows.select(
        "seq", "pieces", F.inline(F.transform(F.sequence(F.lit(0), F.col("pieces") - 1), cut))
    )
    radius = F.floor(F.lit(v) / F.col("pieces"))
    after = F.lit(0)
    for step in range(1, widest + 1):
        rows = _edited(rows, k, radius, step, after)
        after = F.when(F.col(f"_edit{step}.at") > 0, F.col(f"_edit{step}.at")).otherwise(k)
    return rows.select("seq", "pieces", "piece", "offset", "kmer").filter(~has_ambiguous(F.col("kmer")))


def spaced_tiers(min_length: int, below: int, pieces: int) -> list[tuple[int, int, int]]:
    """Piece length, shortest and longest read of each tier of reads shorter than ``below``.

    Longer reads have longer pieces, so that their keys stay rare; the tiers are few, as
    each has a table of keys.
    """
    sizes, step = [min_length // pieces], 1
    while (sizes[-1] + step) * pieces < below:
        sizes.append(sizes[-1] + step)
        step += 1
    if not sizes[0]:
        raise ValueError(f"sequences of {min_length} bases are too short for {pieces} pieces")
    first = [min_length] + [s * pieces for s in sizes[1:]]
    return [(s, a, b) for s, a, b in zip(sizes, first, [*[x - 1 for x in first[1:]], below - 1]) if a <= b]


def _spaced_key(text: Column, at: Column | int, offsets: Sequence[int], s: int) -> Column:
    """Three pieces of ``s`` bases behind one another, with the pattern of their distances."""
    parts = [F.substring(text, at + o * s if isinstance(at, Column) else F.lit(at + o * s), F.lit(s)) for o in offsets]
    return F.concat(*parts, F.lit(f".{offsets[1] - offsets[0]}{offsets[2] - offsets[0]}"))


def spaced_seeds(index: PanelIndex, s: int, pieces: int) -> tuple[DataFrame, int]:
    """Spaced keys of the references' forward strands, written, and their number."""
    if (s, pieces) not in index.spaced:
        begin = F.col("tile") * index.tile
        end = F.least(begin + index.tile, F.col("ref_len") - 3 * s + 1)
        places = index.tiles.filter(end > begin).select(
            *REFERENCE, "tile", "context", "context_start", "ref_len", F.explode(F.sequence(begin, end - 1)).alias("at")
        ).select(
            *REFERENCE, "tile", "at",
            F.substring("context", (F.col("at") - F.col("context_start") + 1).cast("int"), F.lit(s * pieces)).cast("string").alias("_text"),
        )
        keys = [
            F.when(F.length("_text") >= (last + 1) * s, _spaced_key(F.col("_text"), 1, (0, middle, last), s))
            for middle, last in combinations(range(1, pieces), 2)
        ]
        rows = places.select(*REFERENCE, "tile", "at", F.explode(F.array(*keys)).alias("kmer")).filter(
            F.col("kmer").isNotNull() & ~F.col("kmer").rlike("[^ACGT.0-9]")
        )
        table = stage(rows, "spaced-seeds")
        index.spaced[s, pieces] = (table, table.count())
    return index.spaced[s, pieces]


def spaced_hits(reads: DataFrame, index: PanelIndex, v: int, min_length: int, below: int, broadcast_rows: int) -> DataFrame:
    """Hits within ``v`` of the sequences shorter than ``below``, by spaced keys of three exact pieces."""
    pieces, out = v + 3, None
    for s, shortest, longest in spaced_tiers(min_length, below, pieces):
        text = normalise(F.col("seq"))
        sides = F.array(F.struct(F.lit("+").alias("strand"), text.alias("_read")), F.struct(F.lit("-").alias("strand"), revcomp(text).alias("_read")))
        oriented = reads.filter(F.length("seq").between(shortest, longest)).select("seq", F.inline(sides))
        keys = F.array(*[
            F.struct(F.array(*map(F.lit, t)).alias("triple"), _spaced_key(F.col("_read"), 1, t, s).alias("kmer"))
            for t in combinations(range(pieces), 3)
        ])
        probes = oriented.select("seq", "strand", "_read", F.inline(keys)).filter(~F.col("kmer").rlike("[^ACGT.0-9]"))
        table, rows = spaced_seeds(index, s, pieces)
        found = probes.join(join_side(table, rows, 3 * s + 96, broadcast_rows), "kmer").withColumn(
            "pos", F.col("at") - F.get("triple", F.lit(0)) * s
        ).filter("pos >= 0")
        found = _with_window(found, index, broadcast_rows).select(
            "seq", "strand", "triple", *REFERENCE, "pos", F.inline(F.array(F.struct("_window", F.col("_read").alias("_own"))))
        )
        same = lambda m: F.substring("_own", m * s + 1, s) == F.substring("_window", m * s + 1, s)
        first = F.lit(True)
        for m in range(pieces - 1):
            # A window is kept for its first three exact pieces only.
            first = first & ((F.get("triple", F.lit(2)) < m) | F.array_contains("triple", m) | ~same(m))
        mm = F.when(
            F.levenshtein("_own", "_window", v) >= 0,
            F.when(first & ~has_ambiguous(F.col("_window")), mismatches_up_to(F.col("_own"), F.col("_window"), v)),
        )
        hits = found.select("seq", *REFERENCE, "pos", "strand", F.explode(F.array(mm.cast("int"))).alias("mm")).filter("mm is not null")
        out = hits if out is None else out.unionByName(hits)
    return out


def _with_window(found: DataFrame, index: PanelIndex, broadcast_rows: int) -> DataFrame:
    """Join the tiles and cut out the window of a candidate; windows beyond a reference's end go."""
    tiles = join_side(index.tiles, index.tile_rows, index.tile + 2 * index.max_length + 64, broadcast_rows)
    size = F.length("seq")
    window = F.substring("context", (F.col("pos") - F.col("context_start") + 1).cast("int"), size).cast("string")
    return found.join(tiles, [*REFERENCE, "tile"]).filter(F.col("pos") + size <= F.col("ref_len")).withColumn("_window", window)


def all_hits(
    reads: DataFrame,
    index: PanelIndex,
    v: int = 1,
    min_length: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Every window of the panel within ``v`` substitutions of a sequence.

    ``reads`` holds distinct ``seq``. A window found through several pieces is kept
    only for the first piece that could find it, so the result has no duplicates and
    needs no shuffle to remove them. Windows with ambiguous reference bases never match.
    """
    k = index.k
    if (min_length or k) < k:
        raise ValueError("min_length must not be below the seed length")
    shortest = min_length or k
    if by_blocks(index, v, shortest, broadcast_rows):
        hits = _large_hits(reads, index, v, shortest, False, broadcast_rows)
    else:
        hits = _seed_hits(reads, index, v, shortest, broadcast_rows)
    return hits.select(*HIT_COLUMNS, *(["panel"] if index.has_panel else []))


def by_classes(index: PanelIndex, v: int, min_length: int, broadcast_rows: int = BROADCAST_ROWS) -> bool:
    """True where sequences and windows meet in buckets of parts of their beginnings: several mismatches, large references."""
    large = index.seed_rows > min(broadcast_rows, LARGE_ROWS)
    return large and v > 1 and min_length <= WIDEST and min(min_length, classes.LONGER) // (v + 1) >= classes.SHORTEST // 3


def numbered(index: PanelIndex, name: str, rows: Callable[[], DataFrame]) -> DataFrame:
    """A table beside the index, written on first use; ``tiles`` are the index's with a number ``tile_id``."""
    if name not in index.numbered:
        index.numbered[name] = stage(rows(), f"numbered-{name}")
    return index.numbered[name]


def with_place(found: DataFrame, index: PanelIndex, name: str, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``found`` with panel, ref_id and tile of its ``place``, and the position there as ``name``."""
    tiles = join_side(index.numbered["tiles"].select("tile_id", "tile", *REFERENCE), index.tile_rows, 96, broadcast_rows)
    rows = found.withColumn("tile_id", F.floor(F.col("place") / index.tile)).join(tiles, "tile_id")
    return rows.withColumn(name, F.col("tile") * index.tile + F.col("place") % index.tile).drop("place", "tile_id")


def _with_longer(index: PanelIndex, k: int) -> PanelIndex:
    """The same references by longer seeds, made once."""
    if k not in index.reseeded:
        seeds = stage(packed_seeds(index.tiles, k, index.tile), "long-seeds")
        index.reseeded[k] = replace(index, seeds=seeds, k=k, seed_rows=seeds.count(), written=True)
    return index.reseeded[k]


def by_blocks(index: PanelIndex, v: int, min_length: int, broadcast_rows: int = BROADCAST_ROWS) -> bool:
    """True where sequences and references meet in blocks of numbers: large references, with mismatches."""
    if min_length < index.k:
        return False
    large = index.seed_rows > min(broadcast_rows, LARGE_ROWS)
    return large and SHORTEST <= min_length <= WIDTH if v == 1 else by_classes(index, v, min_length, broadcast_rows)


def _large_hits(reads: DataFrame, index: PanelIndex, v: int, min_length: int, best: bool, broadcast_rows: int) -> DataFrame:
    """Hits within ``v`` substitutions on references of which a short seed occurs often, with ``n_hits``.

    ``best`` tells those of a sequence's best class only. ``reads`` need not be distinct.
    """
    size = F.length("seq")
    reads = reads.filter(_within(min_length, index.max_length, size) > 0).select("seq", plain(F.col("seq")).alias("_plain"))
    said = reads.agg(
        F.count("*").alias("rows"), F.max(F.col("seq") != F.col("_plain")).alias("respelt"), F.max(size > WIDEST).alias("long")
    ).first()
    tiles = numbered(index, "tiles", lambda: index.tiles.withColumn("tile_id", F.monotonically_increasing_id()))
    texts = reads.filter(size <= WIDEST).select(F.col("_plain").alias("seq"))
    if v == 1:
        found, made = near_hits(texts, said["rows"], tiles, index.tile, index.seed_rows, min_length, index.strands, best)
        index.windows[min(PREFIX, min_length)], index.longer[SEED] = made["windows"], made["seeds"]
    else:
        found = classes.wide_hits(texts, said["rows"], tiles, index.tile, index.seed_rows, v, min_length, index.strands, best)
    names = join_side(tiles.select("tile_id", "tile", *REFERENCE), index.tile_rows, 96, broadcast_rows)
    offset = F.col("place") % (2 * index.tile) - index.tile
    found = found.withColumn("tile_id", F.floor(F.col("place") / (2 * index.tile))).join(names, "tile_id").select(
        "seq", *REFERENCE, (F.col("tile") * index.tile + offset).alias("pos"), "strand", "mm", "n_hits"
    )
    if said["respelt"]:
        given = reads.filter(size <= WIDEST).distinct()
        found = found.withColumnRenamed("seq", "_plain").join(given, "_plain").select(*found.columns)
    if said["long"]:
        k = min(SEED, (WIDEST + 1) // (v + 1))
        more = _seed_hits(reads.filter(size > WIDEST).select("seq").distinct(), _with_longer(index, k), v, WIDEST + 1, broadcast_rows)
        more = stage(best_stratum(more) if best else more, "long-hits")
        more = more.join(more.groupBy("seq").agg(F.count("*").alias("n_hits")), "seq")
        found = found.unionByName(more.select(*found.columns))
    return found


def _seed_hits(reads: DataFrame, index: PanelIndex, v: int, min_length: int, broadcast_rows: int) -> DataFrame:
    """Hits by seeds of ``index.k`` bases, each window verified: seq, panel, ref_id, pos, strand, mm."""
    k = index.k
    probes = read_probes(reads, k, v, min_length, index.max_length)
    size = F.length("seq")
    start = F.when(F.col("strand") == "+", F.col("at") - F.col("offset")).otherwise(
        F.col("at") - size + F.col("offset") + k
    )
    found = seed_matches(probes, index, broadcast_rows).withColumn("pos", start).filter("pos >= 0")
    found = _with_window(found, index, broadcast_rows)
    oriented = F.when(F.col("strand") == "-", revcomp(F.col("_window"))).otherwise(F.col("_window"))
    # Unfolded from a one-element array, window and read are computed once for all tests on them.
    both = F.struct(oriented.alias("_win"), normalise(F.col("seq")).alias("_read"))
    found = found.select("seq", "pieces", "piece", *REFERENCE, "pos", "strand", F.inline(F.array(both)))
    # One expression, cheapest test first: most candidates fail the banded distance.
    close = F.levenshtein("_read", "_win", v) >= 0 if v > 0 else F.col("_read") == F.col("_win")
    valid = _first_piece(index.k, v) & ~has_ambiguous(F.col("_win"))
    mm = F.when(close, F.when(valid, mismatches_up_to(F.col("_read"), F.col("_win"), v)))
    found = found.select("seq", *REFERENCE, "pos", "strand", F.explode(F.array(mm.cast("int"))).alias("mm"))
    found = found.filter(F.col("mm").isNotNull())
    if v > 1 and min_length < (v + 1) * k:
        found = found.unionByName(spaced_hits(reads, index, v, min_length, (v + 1) * k, broadcast_rows))
    return found


def _first_piece(k: int, v: int) -> Column:
    """True where no earlier piece could have found the same window."""
    size, pieces = F.length("_read"), F.col("pieces")
    ok = F.lit(True)
    for earlier in range(v):
        at = (F.lit(earlier) * F.floor(size / pieces)).cast("int") + 1
        # More than one piece leaves a radius of at most one, where edit distance is exact.
        distance = F.levenshtein(F.substring("_read", at, F.lit(k)), F.substring("_win", at, F.lit(k)), 1)
        reachable = (distance >= 0) & (distance <= F.floor(F.lit(v) / pieces))
        ok = ok & ((F.col("piece") <= earlier) | ~reachable)
    return ok


def near_beginnings(index: PanelIndex, size: int, v: int = 1) -> DataFrame:
    """Numbers of all texts of ``size`` bases within ``v`` (0 or 1) substitutions of a k-mer of the references, written."""
    if (size, v) not in index.sieves:
        changes = [0] + [base << 2 * place for place in range(size) for base in (1, 2, 3) if v]
        own = tile_seeds(index.tiles, size, index.tile, index.strands).select(packed(F.col("kmer")).alias("_own")).distinct()
        near = own.select(F.explode(F.array(*map(F.lit, changes))).alias("_change"), "_own").select(
            F.col("_own").bitwiseXOR(F.col("_change").cast("bigint")).alias("_begin")
        )
        index.sieves[size, v] = stage(near.distinct(), "near-beginnings")
    return index.sieves[size, v]


def sieved(reads: DataFrame, index: PanelIndex, min_length: int, broadcast_rows: int = BROADCAST_ROWS, v: int = 1) -> DataFrame:
    """Sequences that may match a small panel with ``v`` (0 or 1) substitutions; none that does is lost.

    The beginning of such a sequence is within ``v`` substitutions of a k-mer of the panel. All such
    beginnings are one broadcast table, so most reads are asked for one number before any shuffle. Large panels, and
    beginnings so short that random ones pass, leave the reads as they are; so does an unknown base.
    """
    size = min(min_length, 15)
    strands = 2 if index.strands == "both" else 1
    keys = strands * index.seed_rows * (1 + 3 * size * v)
    # A number takes 16 bytes in the table.
    if index.seed_rows * strands > broadcast_rows or keys * 16 > BROADCAST_BYTES or keys * 20 > 4**size:
        return reads
    # Too long or too short ones go on to where they are an error.
    begin = F.substring(normalise(F.col("seq")), 1, size)
    known = F.when(begin.rlike(f"^[ACGT]{{{size}}}$") & F.length("seq").between(min_length, index.max_length), packed(begin))
    rows = reads.withColumn("_begin", F.explode(F.array(known)))
    table = near_beginnings(index, size, v).select("_begin", F.lit(True).alias("_near"))
    return rows.join(F.broadcast(table), "_begin", "left").filter("_begin is null or _near").select(*reads.columns)


def best_hit(hits: DataFrame) -> DataFrame:
    """One hit a sequence: fewest mismatches, then reference, position, strand, panel."""
    order = [c for c in ("mm", "ref_id", "pos", "strand", "panel") if c in hits.columns]
    first = F.min(F.struct(*order)).alias("_h")
    return hits.groupBy("seq").agg(first).select("seq", *[f"_h.{c}" for c in hits.columns if c != "seq"])


def best_stratum(hits: DataFrame) -> DataFrame:
    """All hits at the sequence's own minimum of mismatches."""
    hits = stage(hits, "hits")
    return hits.join(hits.groupBy("seq").agg(F.min("mm").alias("mm")), ["seq", "mm"]).select(*hits.columns)


def mismatch_join(
    reads: DataFrame,
    index: PanelIndex,
    v: int = 1,
    report: str = "all",
    min_length: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    exact_first: bool = False,
    counted: bool = False,
) -> DataFrame:
    """Align sequences to indexed references; case and U or T do not matter, ``seq`` stays as given.

    ``report`` is ``all`` (every hit within ``v``), ``best1`` (one best hit) or
    ``best_strata`` (all hits of the best class). Identical reads are aligned once.

    ``exact_first`` looks for exact hits in a first pass and searches with mismatches
    only for the sequences left over. The result is the same for the two best modes;
    it pays where most reads match exactly, since an exact search asks for one seed a
    read and a search with mismatches for up to dozens on short reads.

    ``counted`` adds ``n_hits``, how many hits of the sequence are reported; on large references with one mismatch
    it costs no further step.
    """
    if report not in ("all", "best1", "best_strata"):
        raise ValueError(f"unknown report mode: {report}")
    wanted, shortest = reads.select("seq"), min_length or index.k
    columns = [*HIT_COLUMNS, *(["panel"] if index.has_panel else []), *(["n_hits"] if counted else [])]
    if by_blocks(index, v, shortest, broadcast_rows):
        hits = _large_hits(wanted, index, v, shortest, report != "all", broadcast_rows)
        if report == "best1":
            hits = best_hit(hits.drop("n_hits")).withColumn("n_hits", F.lit(1).cast("bigint"))
        return hits.select(*columns)
    if counted:
        plain_hits = mismatch_join(reads, index, v, report, min_length, broadcast_rows, exact_first)
        return multihit_count(plain_hits).select(*columns)
    unique = (sieved(wanted, index, shortest, broadcast_rows, v) if v <= 1 else wanted).distinct()
    if report == "all":
        return all_hits(unique, index, v, min_length, broadcast_rows)
    choose = best_hit if report == "best1" else best_stratum
    if not exact_first or v == 0:
        return choose(all_hits(unique, index, v, min_length, broadcast_rows))
    exact = stage(all_hits(unique, index, 0, min_length, broadcast_rows), "exact-hits")
    rest = unaligned(unique, exact)
    inexact = choose(all_hits(rest, index, v, min_length, broadcast_rows))
    return (best_hit(exact) if report == "best1" else exact).unionByName(inexact)


def aligned(reads: DataFrame, hits: DataFrame) -> DataFrame:
    """Reads whose sequence has a hit."""
    return reads.join(hits.select("seq").distinct(), "seq", "left_semi")


def unaligned(reads: DataFrame, hits: DataFrame) -> DataFrame:
    """Reads whose sequence has no hit."""
    return reads.join(hits.select("seq").distinct(), "seq", "left_anti")
