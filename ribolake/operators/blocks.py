"""Rows of numbers that travel in blocks.

A shuffle of single rows carries 40 to 100 bytes for a few numbers. Here a task sorts some hundred thousand rows by
bucket and sends one block a bucket: columns in as few bytes as they need, byte by byte, compressed. Sequences are
two numbers of two bits a base, 31 bases each, from the left.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .staging import ship

# Rows that are sorted together, and bases of a number.
ROWS = 1 << 19
WIDTH = 31
ALL = (1 << 2 * WIDTH) - 1
UNKNOWN = 4
_NUMBER = np.full(256, UNKNOWN, np.uint8)
_NUMBER[[ord(x) for x in "ACGT"]] = range(4)
_LETTERS = np.frombuffer(b"ACGTN", np.uint8)


def pack(columns: Sequence[np.ndarray]) -> bytes:
    """Columns of numbers from 0 on as one block."""
    sizes, parts = [], []
    for values in columns:
        top = int(values.max()) if len(values) else 0
        size = next(s for s in (1, 2, 4, 8) if top < 1 << 8 * s)
        sizes.append(size)
        parts.append(values.astype(f"<u{size}").view(np.uint8).reshape(-1, size).T.tobytes())
    head = np.array([len(columns[0])], "<u4").tobytes() + bytes(sizes)
    return head + pa.compress(b"".join(parts), "zstd", asbytes=True)


def unpack(blocks: pa.ChunkedArray | pa.Array, width: int) -> list[np.ndarray]:
    """The columns of all blocks, one block's rows after another's."""
    columns: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(width)]
    for block in blocks:
        data = block.as_py()
        rows, sizes = int(np.frombuffer(data, "<u4", 1)[0]), data[4:4 + width]
        body = pa.decompress(data[4 + width:], rows * sum(sizes), "zstd", asbytes=True)
        at = 0
        for column, size in zip(columns, sizes):
            part = np.frombuffer(body, np.uint8, rows * size, at).reshape(size, rows)
            column.append(np.ascontiguousarray(part.T).view(f"<u{size}").ravel().astype(np.int64))
            at += rows * size
    return [np.concatenate(parts) for parts in columns]


def mixed(key: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each key."""
    spread = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((spread >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def dealt(part: int, bucket: np.ndarray, columns: Sequence[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """One block for each bucket that has rows: part, bucket, block."""
    if not len(bucket):
        return
    order = np.lexsort((columns[0], bucket))
    bucket, columns = bucket[order], [c[order] for c in columns]
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    ends = np.r_[starts[1:], len(bucket)]
    for at in range(0, len(starts), 256):
        spans = list(zip(starts[at:at + 256], ends[at:at + 256]))
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(spans), part, np.int32)), pa.array(bucket[starts[at:at + 256]].astype(np.int32)),
            pa.array([pack([c[a:b] for c in columns]) for a, b in spans], pa.binary()),
        ], names=["part", "bucket", "block"])


DEALT = "part int, bucket int, block binary"


def gathered(parts: Iterable[Sequence[np.ndarray]], rows: int = ROWS) -> Iterator[list[np.ndarray]]:
    """Columns of several batches joined until they have ``rows`` rows."""
    waiting, size = [], 0
    for part in parts:
        waiting.append(part)
        size += len(part[0])
        if size >= rows:
            yield [np.concatenate(c) for c in zip(*waiting)]
            waiting, size = [], 0
    if size:
        yield [np.concatenate(c) for c in zip(*waiting)]


def packed_rows(rows: DataFrame, *names: str) -> DataFrame:
    """Rows with a ``bucket`` and columns of numbers as blocks: part (always 0), bucket, block."""
    ship(rows.sparkSession)
    return rows.select("bucket", *names).mapInArrow(_pack_rows, DEALT)


def _pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for bucket, *columns in gathered([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns] for b in batches):
        yield from dealt(0, bucket, columns)


def _texts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of texts one after another and where each begins and ends."""
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), ends


def numbers(texts: pa.Array) -> list[np.ndarray]:
    """Texts of up to 62 bases: code, more, their unknown bases as two numbers with a 1 for each, bases."""
    data, ends = _texts(texts)
    sizes = np.diff(ends)
    words = [np.zeros(len(sizes), np.int64) for _ in range(4)]
    for i in range(int(sizes.max(initial=0))):
        some = np.flatnonzero(sizes > i)
        base, shift = _NUMBER[data[ends[some] + i]], 2 * (WIDTH - 1 - i % WIDTH)
        words[i // WIDTH][some] |= (base & 3).astype(np.int64) << shift
        words[2 + i // WIDTH][some] |= (base >> 2).astype(np.int64) << shift
    return [*words, sizes.astype(np.int64)]


def spelt(code: np.ndarray, more: np.ndarray, size: np.ndarray, unknown: Sequence[np.ndarray] = ()) -> pa.Array:
    """The texts of numbers; the bases at ``unknown`` (from 1 on, 0: none) are unknown."""
    shifts = 2 * (WIDTH - 1 - np.arange(WIDTH))
    bases = np.concatenate([(word[:, None] >> shifts & 3).astype(np.uint8) for word in (code, more)], axis=1)
    for at in unknown:
        odd = np.flatnonzero(at)
        bases[odd, at[odd] - 1] = UNKNOWN
    letters = _LETTERS[bases][np.arange(2 * WIDTH) < size[:, None]]
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(letters)))


def _turned(word: np.ndarray) -> np.ndarray:
    """The 31 bases of a number from behind."""
    word = word.astype(np.uint64)
    word = (word >> np.uint64(2) & np.uint64(0x3333333333333333)) | (word & np.uint64(0x3333333333333333)) << np.uint64(2)
    word = (word >> np.uint64(4) & np.uint64(0x0F0F0F0F0F0F0F0F)) | (word & np.uint64(0x0F0F0F0F0F0F0F0F)) << np.uint64(4)
    return word.byteswap() >> np.uint64(2)


def mirrored(code: np.ndarray, more: np.ndarray, size: np.ndarray, complement: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The two numbers of the reverse complement, or of the reverse."""
    flip = ALL if complement else 0
    high, low = _turned(more ^ flip), _turned(code ^ flip)
    off = (2 * (2 * WIDTH - size)).astype(np.uint64)
    width = np.uint64(2 * WIDTH)
    far = off >= width
    near, rest = np.where(far, np.uint64(0), off), np.where(far, off - width, np.uint64(0))
    first = np.where(far, low << rest, high << near | low >> (width - near)) & np.uint64(ALL)
    second = np.where(far, np.uint64(0), low << near) & np.uint64(ALL)
    return first.astype(np.int64), second.astype(np.int64)


def contexts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bases (4 where unknown) of texts with an unknown one behind each, and where each text begins."""
    data, ends = _texts(texts)
    sizes = np.diff(ends)
    starts = ends[:-1] - ends[0] + np.arange(len(sizes))
    bases = np.full(int(sizes.sum()) + len(sizes) + 2 * WIDTH, UNKNOWN, np.uint8)
    inside = np.ones(int(sizes.sum()) + len(sizes), bool)
    inside[starts + sizes] = False
    bases[:len(inside)][inside] = _NUMBER[data[ends[0]:ends[-1]]]
    return bases, starts


def rolling(bases: np.ndarray, width: int) -> np.ndarray:
    """The number of ``width`` bases from each place on; unknown ones and those beyond the end as A."""
    whole = np.where(bases < UNKNOWN, bases, 0).astype(np.int64)
    ahead = lambda values, by: np.concatenate([values[by:], np.zeros(min(by, len(values)), np.int64)])
    out, done, power, size = np.zeros(len(bases), np.int64), 0, whole, 1
    while size <= width:
        if width & size:
            out, done = out << 2 * size | ahead(power, done), done + size
        if size * 2 <= width:
            power = power << 2 * size | ahead(power, size)
        size *= 2
    return out


def known_ahead(bases: np.ndarray) -> np.ndarray:
    """How many known bases follow each place, itself included."""
    place = np.arange(len(bases))
    unknown = np.where(bases == UNKNOWN, place, len(bases))
    return np.minimum.accumulate(unknown[::-1])[::-1] - place
