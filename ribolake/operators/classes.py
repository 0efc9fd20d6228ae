"""Sequences within some substitutions of large references, as numbers that meet in buckets.

The beginning of a sequence is cut into v + 1 parts. Of a window within v substitutions one part is the same, so
sequences and windows meet in the bucket of each part. Inside a task the rest of the beginning is cut into v + 2
pieces, of which two are the same: windows are sorted by the part and two pieces, and every sequence meets only those
that agree there. Candidates are verified whole by a few operations on two numbers of 31 bases each. Where only the
best class of a sequence is wanted, one with exact windows is not asked further, and no worse window than the
best of its bucket leaves the task. Nothing is capped. Both travel in blocks (``blocks``), without texts and ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .blocks import DEALT, WIDTH, dealt, gathered, mirrored, mixed, rolling, unpack
from .nearby import WIDEST, distinct, hit_table, kept, many, marked, met, parted, places_known, read_numbers, tile_rows, told
from .staging import ship

# The shortest beginning, and bases from which on the beginning is longer.
SHORTEST = 12
LONGER = 24


def prefixes(min_length: int, parts: int) -> list[tuple[int, int, int]]:
    """Bases of the beginning, shortest and longest sequence of each tier."""
    if min_length >= LONGER:
        return [(LONGER // parts * parts, min_length, WIDEST)]
    return [(min_length // parts * parts, min_length, LONGER - 1), (LONGER // parts * parts, LONGER, WIDEST)]


def _part(code: np.ndarray, prefix: int, parts: int, part: int) -> np.ndarray:
    size = prefix // parts
    return code >> 2 * (WIDTH - (part + 1) * size) & 4**size - 1


def _deal_reads(batches: Iterator[pa.RecordBatch], prefix: int, parts: int, part: int, buckets: int, sides: int) -> Iterator[pa.RecordBatch]:
    """Texts in the bucket of one part of their beginning, on either strand."""
    for code, more, tail in read_numbers(batches, parts - 1):
        for side in range(sides):
            own = mirrored(code, more, tail >> 6 * (parts - 1))[0] if side else code
            yield from dealt(part, mixed(_part(own, prefix, parts, part), buckets), [code, more, tail << 1 | side])


def _deal_windows(batches: Iterator[pa.RecordBatch], tile: int, prefix: int, parts: int, part: int, shortest: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Windows of up to 62 bases in the bucket of one part of their beginning."""
    def each():
        for bases, place, known, number in places_known(batches, tile, shortest):
            codes = rolling(bases, WIDTH)
            yield [codes[place], codes[place + WIDTH], number, np.minimum(known, WIDEST)]

    for columns in gathered(each()):
        yield from dealt(part, mixed(_part(columns[0], prefix, parts, part), buckets), columns)


def _search(key, reads: pa.Table, windows: pa.Table, prefix: int, v: int, best: bool) -> pa.Table:
    """Hits of the texts of one bucket."""
    part, size, width = key[0].as_py(), prefix // (v + 1), WIDTH
    bits = lambda places: sum(3 << 2 * (prefix - 1 - p) for p in places)
    rest = [p for p in range(prefix) if p // size != part]
    pieces = [bits(rest[len(rest) * i // (v + 2):len(rest) * (i + 1) // (v + 2)]) for i in range(v + 2)]
    parts = [bits(range(i * size, (i + 1) * size)) for i in range(v + 1)]
    codes, more, number, known = unpack(windows.column("block"), 4)
    text, text_more, tail = distinct(unpack(reads.column("block"), 3))
    side, tail = tail & 1, tail >> 1
    sizes, unknown = parted(tail, v)
    turned, turned_more = mirrored(text, text_more, sizes)
    own, own_more = np.where(side == 1, turned, text), np.where(side == 1, turned_more, text_more)
    bad, bad_more = np.zeros_like(own), np.zeros_like(own)
    for at in unknown:
        one, other = marked(at, sizes, side)
        # An unknown base counts whatever stands for it.
        own, own_more, bad, bad_more = own & ~(one * 3), own_more & ~(other * 3), bad | one, bad_more | other
    cut, cut_more = 2 * (width - np.minimum(sizes, width)), 2 * (2 * width - np.maximum(sizes, width))
    begins, own_begins = codes >> 2 * (width - prefix), own >> 2 * (width - prefix)
    least = np.full(len(own), v + 1, np.int8)
    found = []

    def differences(a, b, unknown, beyond):
        differ = (a ^ b)
        return np.bitwise_count((((differ | differ >> 1) & 0x1555555555555555) | unknown) >> beyond)

    def compare(asked, mask, most, earlier):
        """Hits of the reads ``asked`` on windows that agree in ``mask``, for which none of ``earlier`` agrees."""
        keys = begins & mask
        order = np.argsort(keys)
        keys = keys[order]
        wanted = own_begins[asked] & mask
        by_key = np.argsort(wanted)
        asked, wanted = asked[by_key], wanted[by_key]
        low, high = np.searchsorted(keys, wanted, "left"), np.searchsorted(keys, wanted, "right")
        some = np.flatnonzero(high > low)
        ends = np.cumsum(high[some] - low[some])
        done = 0
        while done < len(some):
            # About a million candidates at a time, however frequent a text is.
            before = ends[done - 1] if done else 0
            upto = max(done + 1, int(np.searchsorted(ends, before + (1 << 19), "right")))
            chunk = some[done:upto]
            done, counts = upto, high[chunk] - low[chunk]
            window = order[np.repeat(low[chunk] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())]
            read = np.repeat(asked[chunk], counts)
            wrong = differences(codes[window], own[read], bad[read], cut[read])
            good = np.flatnonzero(wrong <= most)
            read, window, wrong = read[good], window[good], wrong[good]
            wrong = wrong + differences(more[window], own_more[read], bad_more[read], cut_more[read])
            differ = (begins[window] ^ own_begins[read]) | (bad[read] * 3 >> 2 * (width - prefix))
            good = (wrong <= np.minimum(most, least[read]) if best else wrong <= most) & (known[window] >= sizes[read]) & (differ & mask == 0)
            for other in earlier:
                good &= differ & other != 0
            read, window, wrong = read[good], window[good], wrong[good].astype(np.int8)
            if best:
                np.minimum.at(least, read, wrong)
            found.append((read, window, wrong))

    everyone = np.arange(len(own))
    if len(own) and len(codes):
        whole = bits(range(prefix))
        if best:
            # A window that is the same is found in the bucket of every part and reported in the first.
            compare(everyone, whole, 0, [])
            if part:
                found.clear()
            everyone = np.flatnonzero(least > 0)
        for i, j in combinations(range(v + 2), 2):
            earlier = [p for x, p in enumerate(pieces) if x < j and x != i] + parts[:part]
            compare(everyone, parts[part] | pieces[i] | pieces[j], v, earlier)
    kinds = (np.int64, np.int64, np.int8)
    read, window, wrong = (np.concatenate([np.zeros(0, kind), *[f[c] for f in found]]) for c, kind in enumerate(kinds))
    if best:
        good = wrong == least[read]
        read, window, wrong = read[good], window[good], wrong[good]
    return hit_table([(text[read], text_more[read], tail[read], side[read], wrong.astype(np.int64), number[window])])


def wide_hits(
    reads: DataFrame, read_rows: int, tiles: DataFrame, tile: int, window_rows: int, v: int, min_length: int, strands: str, best: bool
) -> DataFrame:
    """Hits within ``v`` substitutions of ``plain`` sequences of ``min_length`` to 62 bases: seq, place, strand, mm, n_hits.

    As ``near_hits``. An unknown base of a sequence is a substitution. The parts are searched one after the other, so only
    one part's shuffle is on disk; the hits of each are written.
    """
    ship(reads.sparkSession)
    hits, parts, sides = [], v + 1, 2 if strands == "both" else 1
    for part in range(parts):
        found = None
        for prefix, shortest, longest in prefixes(min_length, parts):
            buckets = many(window_rows, read_rows * sides, 4 ** (prefix // parts))
            same = dict(prefix=prefix, parts=parts, part=part, buckets=buckets)
            asked = reads.filter(F.length("seq").between(shortest, longest)).select("seq").mapInArrow(partial(_deal_reads, sides=sides, **same), DEALT)
            windows = tile_rows(tiles).mapInArrow(partial(_deal_windows, tile=tile, shortest=shortest, **same), DEALT)
            more = met(asked, windows, partial(_search, prefix=prefix, v=v, best=best))
            found = more if found is None else found.unionByName(more)
        hits.append(kept(found, read_rows))
    return told(hits, v, best)
