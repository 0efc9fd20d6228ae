"""Vectorised words and hashes over a batch of texts, for use inside tasks.

A batch is handled as one run of bytes, so the work per word is a few array operations.
White space is the six ASCII characters of ``common.SPACE``; bytes of longer code points
are never mistaken for them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_CHUNK_BYTES = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (splitmix64)."""
    x = x + _STEP
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_VALUES = mixed(np.arange(256, dtype=np.uint64))
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_VALUES_LOWER = _VALUES[_LOWER]
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True


def chunks(column: pa.Array, limit: int = _CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, end row, bytes and offsets of runs of texts of about ``limit`` bytes."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    begin = 0
    while begin < n:
        end = max(begin + 1, int(np.searchsorted(ends, ends[begin] + limit, "right")) - 1)
        yield begin, end, raw[ends[begin] : ends[end]], ends[begin : end + 1] - ends[begin]
        begin = end


class Words:
    """Words of several texts: ``hashes`` in order and ``bounds`` of each text's words."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, lower: bool = True, split_marks: bool = False):
        solid = ~_SPACES[raw]
        fresh = np.zeros(len(raw) + 1, bool)
        fresh[offsets] = True
        if split_marks:
            kind = _KINDS[raw]
            changed = np.concatenate(([True], kind[1:] != kind[:-1])) if len(raw) else np.zeros(0, bool)
        else:
            changed = np.concatenate(([True], ~solid[:-1])) if len(raw) else np.zeros(0, bool)
        self.starts = np.flatnonzero(solid & (changed | fresh[:-1]))
        self.bounds = np.searchsorted(self.starts, offsets)
        if not len(self.starts):
            self.hashes = np.zeros(0, np.uint64)
            return
        sizes = np.diff(np.append(self.starts, len(raw)))
        place = np.arange(self.starts[0], len(raw)) - np.repeat(self.starts, sizes)
        powers = np.cumprod(np.full(int(sizes.max()) + 1, 0x5851F42D4C957F2D, np.uint64))
        values = (_VALUES_LOWER if lower else _VALUES)[raw[self.starts[0] :]] * powers[place]
        values[~solid[self.starts[0] :]] = 0
        self.hashes = mixed(np.add.reduceat(values, self.starts - self.starts[0]))
        self.raw = raw

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


# Letters, digits and longer code points against other marks, for tokens that split at marks.
_KINDS = np.full(256, 2, np.uint8)
_KINDS[[9, 10, 11, 12, 13, 32]] = 0
_KINDS[48:58] = _KINDS[65:91] = _KINDS[97:123] = _KINDS[128:] = 1


def owners(bounds: np.ndarray) -> np.ndarray:
    """Text number of every word."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every run of ``n`` words; a shorter text is one run."""
    hashes, bounds, counts = words.hashes, words.bounds, words.counts()
    factors = mixed(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)
    salts = mixed(np.arange(n, dtype=np.uint64) + np.uint64(1 << 20))
    owner = owners(bounds)
    last = np.maximum(bounds[1:] - n, bounds[:-1] - 1)  # last start, or none
    start = np.arange(len(hashes))
    # Short texts: their first word starts the only run, which ends with the text.
    short = (counts > 0) & (counts < n)
    whole = start[start <= last[owner]] if len(hashes) else start
    value = np.zeros(len(whole), np.uint64)
    for j in range(n):
        value += hashes[whole + j] * factors[j]
    rows, extra_rows, extra = owner[whole], np.flatnonzero(short), []
    for row in extra_rows:
        part = hashes[bounds[row] : bounds[row + 1]]
        extra.append((part * factors[: len(part)]).sum(dtype=np.uint64) ^ salts[len(part)])
    rows = np.concatenate([rows, extra_rows])
    return rows, mixed(np.concatenate([value, np.array(extra, np.uint64)]))


def distinct(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of every row."""
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    keep = np.ones(len(rows), bool)
    keep[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return rows[keep], values[keep]
