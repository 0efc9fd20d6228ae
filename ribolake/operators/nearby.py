"""Sequences within one substitution of large references, without unfolding their neighbourhoods in a shuffle.

Short sequences (up to 31 bases): the first bases are cut in two halves. Of a window within one substitution one half is
the same, so sequences and windows meet in the bucket of either half. Only inside a task are the substitutions of the
other half tried, by binary search in the bucket's sorted windows. Long ones (up to 62 bases) have one exact half in
their first 32 bases: it is looked up among the references' 16-mers, whichever strand they are on, and the places that
answer meet the text of their tile. Windows and sequences are numbers of two bits a base and travel in blocks
(``blocks``); a sequence is known by its numbers until its hits are brought together, so no text and no id of a sequence
or a reference is shuffled. Nothing is capped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.sequence import normalise
from . import blocks
from .blocks import DEALT, ROWS, UNKNOWN, WIDTH, dealt, gathered, mirrored, mixed, packed_rows, unpack
from .staging import ship, stage

# Bases by which windows are looked up, the shortest sequence, bases of the two numbers, and of a half of a long beginning.
PREFIX = 14
SHORTEST = 10
WIDEST = 2 * WIDTH
SEED = 16
# Windows, seeds and sequences of an average bucket.
BUCKET_ROWS = 25_000
READ_ROWS = 100_000
HIT_READS = 50_000

# A hit until it is brought together: the sequence's numbers, its bases and unknown base, strand, place, mismatches.
HIT = ("code", "more", "tail", "side", "mm", "place")
HIT_SCHEMA = "code bigint, more bigint, tail bigint, side bigint, mm bigint, place bigint"


def packed(kmer: Column) -> Column:
    """A k-mer of up to 31 bases A, C, G, T as a number, two bits a base."""
    return F.conv(F.translate(kmer, "ACGT", "0123"), 4, 10).cast("bigint")


def plain(seq: Column) -> Column:
    """A sequence in upper case, as DNA, every unknown base as N."""
    return F.regexp_replace(normalise(seq), "[^ACGT]", "N")


def read_numbers(batches: Iterator[pa.RecordBatch], v: int = 1) -> Iterator[list[np.ndarray]]:
    """Numbers of distinct texts: code, more, tail. The tail holds the bases and, six bits each, the places of unknown ones.

    With more than ``v`` unknown bases no window is within ``v`` substitutions.
    """
    def each():
        for batch in batches:
            code, more, bad, bad_more, size = blocks.numbers(batch.column(0))
            good = (np.bitwise_count(bad).astype(np.int64) + np.bitwise_count(bad_more) <= v) & (size > 0)
            tail = size
            for _ in range(v):
                # The last one that is set.
                low, low_more = bad & -bad, bad_more & -bad_more
                bit = lambda word: np.frexp(np.maximum(word, 1).astype(float))[1] - 1
                at = np.where(low_more > 0, 2 * WIDTH - bit(low_more) // 2, np.where(low > 0, WIDTH - bit(low) // 2, 0))
                bad, bad_more = np.where(low_more > 0, bad, bad ^ low), bad_more ^ low_more
                tail = tail << 6 | at
            yield [code[good], more[good], tail[good]]

    for columns in gathered(each()):
        yield distinct(columns)


def parted(tail: np.ndarray, v: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Bases, and the places of unknown ones, from 1 on; 0 for none."""
    return tail >> 6 * v, [tail >> 6 * i & 63 for i in range(v)]


def distinct(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Each row of numbers once."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return [c[new] for c in columns]


def marked(at: np.ndarray, size: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The unknown base as two numbers with a 1 for it, on the strand of ``side``."""
    place = np.where(side == 1, size - at, at - 1)
    bit = lambda word: np.where((at > 0) & (place // WIDTH == word), np.int64(1) << 2 * (WIDTH - 1 - place % WIDTH), 0)
    return bit(0), bit(1)


def _halves(code: np.ndarray, prefix: int) -> list[np.ndarray]:
    first, second = prefix // 2, prefix - prefix // 2
    begin = code >> 2 * (WIDTH - prefix)
    return [begin >> 2 * second, begin & 4**second - 1]


def _deal_short(batches: Iterator[pa.RecordBatch], prefix: int, buckets: int, sides: int) -> Iterator[pa.RecordBatch]:
    """Short texts in the bucket of either half of their beginning, on either strand."""
    for code, _, tail in read_numbers(batches):
        for side in range(sides):
            own = mirrored(code, np.zeros_like(code), tail >> 6)[0] if side else code
            for part, half in enumerate(_halves(own, prefix)):
                yield from dealt(part, mixed(half, buckets), [code, tail << 1 | side])


def _deal_long(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Long texts in the bucket of either half of their first 32 bases, the smaller one of the half and its reverse complement."""
    for code, more, tail in read_numbers(batches):
        at = tail & 63
        for half, seed in enumerate((code >> 30, (code & (1 << 30) - 1) << 2 | more >> 60)):
            known = (at <= half * SEED) | (at > (half + 1) * SEED)
            least, turned = _canonical(seed[known])
            yield from dealt(0, mixed(least, buckets), [code[known], more[known], (tail[known] << 1 | half) << 2 | turned])


def _canonical(seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smaller of a 16-mer and its reverse complement; 0 for the first, 1 for the other, 2 where they are the same."""
    left = seed << 30
    mirror = mirrored(left, np.zeros_like(left), np.full(len(left), SEED))[0] >> 30
    return np.minimum(seed, mirror), np.where(seed == mirror, 2, np.where(seed > mirror, 1, 0))


def places_known(batches: Iterator[pa.RecordBatch], tile: int, shortest: int):
    """Places that begin in each tile with ``shortest`` known bases: bases, their place among them, and the place's number.

    The number holds tile and offset; the offset may be negative or beyond the tile.
    """
    for batch in batches:
        room = np.cumsum(np.asarray(batch.column("size")))
        begin = 0
        while begin < len(room):
            # Some hundred thousand bases at a time.
            end = max(begin + 1, int(np.searchsorted(room, (room[begin - 1] if begin else 0) + ROWS, "right")))
            part = batch.slice(begin, end - begin)
            begin = end
            column = lambda name: part.column(name).to_numpy(zero_copy_only=False).astype(np.int64)  # noqa: B023, E731
            bases, starts = blocks.contexts(part.column("context"))
            number, first, last = column("tile"), column("context_start"), column("ref_len")
            own = np.maximum(0, np.minimum(tile, last - shortest + 1 - number * tile))
            offset = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
            place = offset + np.repeat(starts + number * tile - first, own)
            known = blocks.known_ahead(bases)[place]
            good = known >= shortest
            yield bases, place[good], known[good], (np.repeat((column("tile_id") * 2 + 1) * tile, own) + offset)[good]


def _deal_windows(batches: Iterator[pa.RecordBatch], tile: int, prefix: int, shortest: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Windows of up to 31 bases in the bucket of either half of their beginning."""
    def each():
        for bases, place, known, number in places_known(batches, tile, shortest):
            yield [blocks.rolling(bases, WIDTH)[place], number, np.minimum(known, WIDTH)]

    for code, number, known in gathered(each()):
        for part, half in enumerate(_halves(code, prefix)):
            yield from dealt(part, mixed(half, buckets), [code, number, known])


def _deal_seeds(batches: Iterator[pa.RecordBatch], tile: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """16-mers of the references in the bucket of the smaller one of theirs."""
    def each():
        for bases, place, _, number in places_known(batches, tile, SEED):
            yield [*_canonical(blocks.rolling(bases, SEED)[place]), number]

    for least, turned, number in gathered(each()):
        yield from dealt(0, mixed(least, buckets), [least, number, turned])


def chunks(low: np.ndarray, high: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a question and each of its answers low to high, about ``size`` at a time, however many a question has."""
    some = np.flatnonzero(high > low)
    ends = np.cumsum(high[some] - low[some])
    done = 0
    while done < len(some):
        before = ends[done - 1] if done else 0
        upto = max(done + 1, int(np.searchsorted(ends, before + size, "right")))
        chunk = some[done:upto]
        done, counts = upto, high[chunk] - low[chunk]
        yield np.repeat(chunk, counts), np.repeat(low[chunk] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def hit_table(found: list[tuple[np.ndarray, ...]]) -> pa.Table:
    return pa.table([pa.array(np.concatenate([np.zeros(0, np.int64), *[f[i] for f in found]])) for i in range(len(HIT))], names=list(HIT))


def _search_short(key, reads: pa.Table, windows: pa.Table, prefix: int) -> pa.Table:
    """Hits of the short texts of one bucket."""
    part, half = key[0].as_py(), prefix // 2
    # Bits of the half that may differ; the same text is found by the first half only.
    places = range(prefix - half) if part == 0 else range(prefix - half, prefix)
    changes = np.array(([0] if part == 0 else []) + [base << 2 * place for place in places for base in (1, 2, 3)], np.int64)
    codes, number, known = unpack(windows.column("block"), 3)
    order = np.argsort(codes, kind="stable")
    codes, number, known = codes[order], number[order], known[order]
    begins = codes >> 2 * (WIDTH - prefix)
    text, tail = distinct(unpack(reads.column("block"), 2))
    side, size, at = tail & 1, tail >> 7, tail >> 1 & 63
    own = np.where(side == 1, mirrored(text, np.zeros_like(text), size)[0], text)
    bad, _ = marked(at, size, side)
    beyond = 2 * (WIDTH - size)
    found = []
    step = 1 << 14
    for begin in range(0, len(own), step):
        asked = ((own[begin:begin + step] >> 2 * (WIDTH - prefix))[:, None] ^ changes).ravel()
        low, high = np.searchsorted(begins, asked, "left"), np.searchsorted(begins, asked, "right")
        for question, window in chunks(low, high, 1 << 21):
            read = question // len(changes) + begin
            differ = codes[window] ^ own[read]
            differ = ((differ | differ >> 1) & 0x1555555555555555 | bad[read]) >> beyond[read]
            good = ((differ & (differ - 1)) == 0) & (known[window] >= size[read])
            read, window, wrong = read[good], window[good], (differ[good] != 0).astype(np.int64)
            found.append((text[read], np.zeros_like(read), tail[read] >> 1, side[read], wrong, number[window]))
    return hit_table(found)


def _search_long(key, reads: pa.Table, seeds: pa.Table, both: bool) -> pa.Table:
    """Where the long texts of one bucket may lie, not yet compared; ``mm`` is the half that was found."""
    least, number, turned = unpack(seeds.column("block"), 3)
    order = np.argsort(least, kind="stable")
    least, number, turned = least[order], number[order], turned[order]
    code, more, tail = distinct(unpack(reads.column("block"), 3))
    own_turned, half, tail = tail & 3, tail >> 2 & 1, tail >> 3
    seed = np.where(half == 1, (code & (1 << 30) - 1) << 2 | more >> 60, code >> 30)
    asked, _ = _canonical(seed)
    found = []
    low, high = np.searchsorted(least, asked, "left"), np.searchsorted(least, asked, "right")
    for read, place in chunks(low, high, 1 << 20):
        before = half[read] * SEED
        for side in range(1 + both):
            good = (turned[place] == 2) | ((turned[place] != own_turned[read]) == side)
            r, p = read[good], place[good]
            start = number[p] - (before[good] if side == 0 else (tail[r] >> 6) - before[good] - SEED)
            found.append((code[r], more[r], tail[r], np.full(len(r), side), half[r], start))
    return hit_table(found)


def _verify(key, asked: pa.Table, tiles: pa.Table, tile: int) -> pa.Table:
    """Of the places where long texts may lie those within one substitution; one that the first half finds is told by it."""
    code, more, tail, side, half, place = unpack(asked.column("block"), len(HIT))
    ids = tiles.column("tile_id").to_numpy()
    order = np.argsort(ids)
    if not len(ids) or not len(code):
        return hit_table([])
    which = order[np.searchsorted(ids[order], place // (2 * tile))]
    bases, starts = blocks.contexts(tiles.column("context").combine_chunks())
    number, first, last = (tiles.column(c).to_numpy().astype(np.int64) for c in ("tile", "context_start", "ref_len"))
    size, at = tail >> 6, tail & 63
    begin = number[which] * tile + place % (2 * tile) - tile
    inside = np.flatnonzero((begin >= 0) & (begin + size <= last[which]))
    begin = starts[which] + begin - first[which]
    columns, shifts, found = np.arange(WIDEST), 2 * (WIDTH - 1 - np.arange(WIDTH)), []
    for r in (inside[i:i + (1 << 15)] for i in range(0, len(inside), 1 << 15)):
        own = np.concatenate([(word[r][:, None] >> shifts & 3).astype(np.uint8) for word in (code, more)], axis=1)
        odd = np.flatnonzero(at[r])
        own[odd, at[r][odd] - 1] = UNKNOWN + 1
        back, n = side[r][:, None] == 1, size[r][:, None]
        there = bases[np.clip(begin[r][:, None] + np.where(back, n - 1 - columns, columns), 0, len(bases) - 1)]
        within = columns < n
        clear = ~((there == UNKNOWN) & within).any(axis=1)
        there = np.where(back & (there < UNKNOWN), 3 - there, there)
        differ = (own != there) & within
        wrong = differ.sum(axis=1)
        good = clear & (wrong <= 1) & ((half[r] == 0) | differ[:, :SEED].any(axis=1))
        r, wrong = r[good], wrong[good].astype(np.int64)
        found.append((code[r], more[r], tail[r], side[r], wrong, place[r]))
    return hit_table(found)


def _told(key, hits: pa.Table, v: int, best: bool) -> pa.Table:
    """The hits of some sequences, all or those with the fewest mismatches of each, with their texts and numbers of hits."""
    columns = unpack(hits.column("block"), len(HIT))
    order = np.lexsort((columns[2], columns[1], columns[0]))
    code, more, tail, side, mm, place = (c[order] for c in columns)
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (more[1:] != more[:-1]) | (tail[1:] != tail[:-1])
    starts, group = np.flatnonzero(new), np.cumsum(new) - 1
    kept = np.ones(len(code), bool)
    if best and len(code):
        kept = mm == np.minimum.reduceat(mm, starts)[group]
    texts = blocks.spelt(code[starts], more[starts], *parted(tail[starts], v))
    group, side, mm, place = group[kept], side[kept], mm[kept], place[kept]
    counts = np.bincount(group, minlength=len(starts))
    return pa.table([
        texts.take(pa.array(group)), pa.array(place), pa.array(["+", "-"]).take(pa.array(side)), pa.array(mm.astype(np.int32)), pa.array(counts[group].astype(np.int64)),
    ], names=["seq", "place", "strand", "mm", "n_hits"])


def met(left: DataFrame, right: DataFrame, search: Callable) -> DataFrame:
    """Hits of the blocks of sequences and of references that share a bucket."""
    # Spark takes a plain function of three.
    run = lambda key, a, b: search(key, a, b)
    return left.groupBy("part", "bucket").cogroup(right.groupBy("part", "bucket")).applyInArrow(run, HIT_SCHEMA)


def many(window_rows: int, read_rows: int, most: int = 1 << 20) -> int:
    """Buckets for so many windows and sequences."""
    return int(max(16, min(most, max(window_rows // BUCKET_ROWS, read_rows // READ_ROWS))))


def kept(hits: DataFrame, read_rows: int) -> DataFrame:
    """Hits written as blocks, in buckets of sequences; what was shuffled for them goes."""
    bucket = F.pmod(F.xxhash64("code", "more", "tail"), F.lit(max(16, read_rows // HIT_READS))).cast("int").alias("bucket")
    return stage(packed_rows(hits.select("*", bucket), *HIT), "hit-blocks")


def told(hits: list[DataFrame], v: int, best: bool) -> DataFrame:
    """What ``kept`` wrote as seq, place, strand, mm, n_hits."""
    run = partial(_told, v=v, best=best)
    return reduce(DataFrame.unionByName, hits).groupBy("bucket").applyInArrow(
        lambda key, rows: run(key, rows), "seq string, place bigint, strand string, mm int, n_hits bigint"
    )


def tile_rows(tiles: DataFrame) -> DataFrame:
    """What ``places_known`` reads."""
    return tiles.select("tile_id", "tile", "context_start", "ref_len", "context", F.octet_length("context").alias("size"))


def near_hits(
    reads: DataFrame, read_rows: int, tiles: DataFrame, tile: int, window_rows: int, min_length: int, strands: str, best: bool
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Hits within one substitution of ``plain`` sequences of up to 62 bases: seq, place, strand, mm, n_hits.

    ``reads``: seq, not necessarily distinct, about ``read_rows``. ``tiles`` have a number ``tile_id``; a place is
    twice that number and one, times the tile's bases, and the offset from the tile's beginning. With ``best`` only the hits of a
    sequence's best class are told; ``n_hits`` counts what is told. Also given: the blocks of windows and of seeds.
    Short and long sequences are searched one after the other, so only one's shuffle is on disk.
    """
    ship(reads.sparkSession)
    prefix, sides = min(PREFIX, min_length), 2 if strands == "both" else 1
    buckets, seed_buckets = many(window_rows, read_rows * sides, 4 ** (prefix // 2)), many(window_rows, read_rows)
    windows = tile_rows(tiles).mapInArrow(partial(_deal_windows, tile=tile, prefix=prefix, shortest=min_length, buckets=buckets), DEALT)
    seeds = tile_rows(tiles).mapInArrow(partial(_deal_seeds, tile=tile, buckets=seed_buckets), DEALT)
    length = F.length("seq")
    short = reads.filter(length <= WIDTH).select("seq").mapInArrow(partial(_deal_short, prefix=prefix, buckets=buckets, sides=sides), DEALT)
    long = reads.filter(length > WIDTH).select("seq").mapInArrow(partial(_deal_long, buckets=seed_buckets), DEALT)
    hits = [kept(met(short, windows, partial(_search_short, prefix=prefix)), read_rows)]
    maybe = met(long, seeds, partial(_search_long, both=sides == 2))
    # Tiles of an average bucket hold about as many bases as a bucket of windows.
    tile_bucket = lambda number: F.pmod(F.xxhash64(number), F.lit(many(window_rows, 0))).cast("int").alias("bucket")
    asked = packed_rows(maybe.select("*", tile_bucket(F.floor(F.col("place") / (2 * tile)))), *HIT)
    texts = tiles.select("tile_id", "tile", "context_start", "ref_len", "context", F.lit(0).alias("part"), tile_bucket(F.col("tile_id")))
    hits.append(kept(met(asked, texts, partial(_verify, tile=tile)), read_rows))
    return told(hits, 1, best), {"windows": windows, "seeds": seeds}
