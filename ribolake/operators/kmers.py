"""Look-up of the k-mers of reads in a table of known ones, column by column inside Arrow tasks.

A task turns the bases of a batch into numbers of two bits a base, for all reads at once, and searches them in
the sorted numbers of the known k-mers. No read is unfolded into rows and nothing is shuffled. The known k-mers are
sent to every task, so callers check their number first (``fits``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructType

from .nearby import WIDTH, packed
from .staging import BROADCAST_ROWS, ship


def fits(rows: int, k: int) -> bool:
    """True where k-mers are short enough for a number and few enough for every task."""
    return k <= WIDTH and rows <= BROADCAST_ROWS


def batch_codes(texts, k: int, m: int | None = None, mask: int = 0):
    """Number of the canonical k-mer at every place of a batch of sequences, and the row each is in.

    Case and U or T do not matter; k-mers with any other character are left out. With ``m`` the number is that of
    the k-mer's minimizer, the canonical m-mer in it that is smallest once ``mask`` is mixed in.
    """
    import numpy as np
    import pyarrow as pa

    texts = texts.cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    lengths = np.diff(ends)
    digit = np.full(256, 4, np.uint8)
    for letters, value in (("Aa", 0), ("Cc", 1), ("Gg", 2), ("TtUu", 3)):
        digit[[ord(c) for c in letters]] = value
    data = texts.buffers()[2]
    base = digit[np.frombuffer(data, np.uint8)[ends[0]:ends[-1]]] if data is not None and len(texts) else np.zeros(0, np.uint8)
    row = np.repeat(np.arange(len(texts)), lengths)
    if len(base) < k:
        return np.zeros(0, np.int64), row[:0]
    m = m or k
    # Both strands by doubling: a text of a + b bases from texts of a and of b.
    plus, minus, size = {1: base.astype(np.int64) & 3}, {1: 3 - (base.astype(np.int64) & 3)}, 1
    while 2 * size <= m:
        n = len(plus[size]) - size
        plus[2 * size] = (plus[size][:n] << 2 * size) | plus[size][size:size + n]
        minus[2 * size] = (minus[size][size:size + n] << 2 * size) | minus[size][:n]
        size *= 2
    done, ahead, back = 0, None, None
    for part in sorted(plus, reverse=True):
        if part & m:
            if done == 0:
                ahead, back = plus[part], minus[part]
            else:
                n = min(len(ahead), len(plus[part]) - done)
                ahead = (ahead[:n] << 2 * part) | plus[part][done:done + n]
                back = (minus[part][done:done + n] << 2 * done) | back[:n]
            done += part
    n = len(base) - k + 1
    unknown = np.concatenate(([0], np.cumsum(base == 4)))
    valid = (unknown[k:] == unknown[:n]) & (row[:n] == row[k - 1:])
    every = np.minimum(ahead, back) ^ mask
    least = every[:n]
    for step in range(1, k - m + 1):
        least = np.minimum(least, every[step:step + n])
    return least[valid] ^ mask, row[:n][valid]


class Known:
    """Sorted numbers with a table of bits before them, which ends the search for most others."""

    BITS = 22

    def __init__(self, codes):
        import numpy as np

        self.codes = codes
        self.some = np.zeros(1 << self.BITS, bool)
        self.some[self._slot(codes)] = True

    def _slot(self, codes):
        import numpy as np

        return (codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)

    def find(self, codes):
        """Which of ``codes`` are known, and their places."""
        import numpy as np

        if not len(self.codes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        asked = np.flatnonzero(self.some[self._slot(codes)])
        place = np.minimum(np.searchsorted(self.codes, codes[asked]), len(self.codes) - 1)
        same = self.codes[place] == codes[asked]
        return asked[same], place[same]


def sorted_codes(table: DataFrame, *columns: str | Column) -> tuple:
    """The packed ``kmer`` of a checked small table, ascending, and further number columns in the same order."""
    rows = table.select(packed(F.col("kmer")).alias("_code"), *columns).toArrow().sort_by("_code")
    return tuple(rows.column(i).combine_chunks().to_numpy() for i in range(rows.num_columns))


def with_found(rows: DataFrame, known: DataFrame, k: int) -> DataFrame:
    """``rows`` with ``found``, how many k-mers of ``seq`` are in ``known`` (distinct canonical ``kmer``)."""
    ship(rows.sparkSession)
    (codes,) = sorted_codes(known)

    def counted(batches):
        import numpy as np
        import pyarrow as pa

        table = Known(codes)
        for batch in batches:
            asked, row = batch_codes(batch.column("seq"), k)
            found = np.bincount(row[table.find(asked)[0]], minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.astype(np.int64))], names=[*batch.schema.names, "found"])

    return rows.mapInArrow(counted, StructType([*rows.schema.fields]).add("found", LongType()))


def ancestors(lineages: Sequence[tuple[int, ...]]) -> tuple:
    """Of each lineage, given in ascending order, the places of those it begins with, itself included: ends and places."""
    import numpy as np

    place = {lineage: i for i, lineage in enumerate(lineages)}
    lists = [[place[x[:n]] for n in range(len(x) + 1) if x[:n] in place] for x in lineages]
    return np.cumsum([0, *map(len, lists)]), np.array([p for one in lists for p in one], np.int64)


def best_taxa(key, hits, taxa: int, ends, places):
    """Rows, their best score, and the first and last taxon that has it, from ascending ``row * taxa + taxon`` and hits."""
    import numpy as np

    row, taxon = key // taxa, key % taxa
    sizes = (ends[1:] - ends[:-1])[taxon]
    source = np.repeat(np.arange(len(key)), sizes)
    step = np.arange(len(source)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    wanted = row[source] * taxa + places[ends[taxon[source]] + step]
    at = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
    score = np.bincount(source, np.where(key[at] == wanted, hits[at], 0), len(key)).astype(np.int64)
    starts = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
    best = np.maximum.reduceat(score, starts)
    top = np.flatnonzero(score == np.repeat(best, np.diff(np.append(starts, len(key)))))
    first = np.flatnonzero(np.concatenate(([True], row[top][1:] != row[top][:-1])))
    last = np.append(first[1:], len(top)) - 1
    return row[starts], best, taxon[top[first]], taxon[top[last]]


def with_taxa(rows: DataFrame, lca: DataFrame, k: int, m: int | None = None, mask: int = 0) -> DataFrame:
    """``rows`` with ``taxid`` and ``score`` by the rules of ``taxonomy.classify``.

    ``lca`` is a checked small table of a ``kmer`` as text, or with ``m`` of a ``minimizer`` as number, and its lineage.
    """
    ship(rows.sparkSession)
    lineages = sorted(tuple(r[0]) for r in lca.select("lineage").distinct().collect())
    ends, places = ancestors(lineages)
    number = {lineage: i for i, lineage in enumerate(lineages)}
    code = F.col("minimizer") if m else packed(F.col("kmer"))
    table = lca.select(code.alias("_code"), "lineage").collect()
    pairs = sorted((r["_code"], number[tuple(r["lineage"])]) for r in table)

    def named(batches):
        import numpy as np
        import pyarrow as pa

        known = Known(np.array([code for code, _ in pairs], np.int64))
        taxon = np.array([t for _, t in pairs], np.int64)
        for batch in batches:
            taxid, score = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int64)
            asked, row = batch_codes(batch.column("seq"), k, m, mask)
            found, place = known.find(asked)
            if len(found):
                key, hits = np.unique(row[found] * len(lineages) + taxon[place], return_counts=True)
                at, best, first, last = best_taxa(key, hits, len(lineages), ends, places)
                score[at] = best
                ties, which = np.unique(first * len(lineages) + last, return_inverse=True)
                common = []
                for tie in ties:
                    a, b = lineages[tie // len(lineages)], lineages[tie % len(lineages)]
                    n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
                    common.append(a[n - 1] if n else 0)
                taxid[at] = np.array(common, np.int32)[which]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(taxid), pa.array(score)], names=[*batch.schema.names, "taxid", "score"]
            )

    return rows.mapInArrow(named, StructType([*rows.schema.fields]).add("taxid", IntegerType()).add("score", LongType()))


# Buckets of a sample's k-mers, and samples whose counters a task holds at once.
BUCKETS = 1 << 13
HELD = 64


def _places(texts, k: int, first: int):
    """Characters of a batch as numbers, and row and start of every k-mer from place ``first`` of its text on."""
    import numpy as np

    whole = "".join(t or "" for t in texts.to_pylist())
    units = np.frombuffer(whole.encode(), np.uint8) if whole.isascii() else np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    lengths = np.array([len(t or "") for t in texts.to_pylist()], np.int64)
    counts = np.maximum(lengths - k - first + 1, 0)
    row = np.repeat(np.arange(len(lengths)), counts)
    begins = np.cumsum(lengths) - lengths + first
    return units, row, np.arange(len(row)) + np.repeat(begins - (np.cumsum(counts) - counts), counts)


def _buckets(units, at, k: int):
    """Bucket of the k-mer at each place; equal ones have equal buckets in every batch."""
    import numpy as np

    n = max(len(units) - k + 1, 0)
    mixed = np.zeros(n, np.uint64)
    for i in range(k):
        mixed = mixed * np.uint64(0x100000001B3) + units[i:i + n]
    return ((mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)[at]


def bucket_counts(reads: DataFrame, k: int, first: int) -> DataFrame:
    """sample, bucket and how many k-mers of ``seq`` from place ``first`` on fall into it, counted once a task."""
    ship(reads.sparkSession)
    schema = StructType([reads.schema["sample"]]).add("bucket", IntegerType()).add("n", LongType())

    def counted(batches):
        import numpy as np
        import pyarrow as pa

        held = {}

        def rows():
            for sample, counts in held.items():
                some = np.flatnonzero(counts)
                columns = [pa.array([sample] * len(some), kind), pa.array(some.astype(np.int32)), pa.array(counts[some])]
                yield pa.RecordBatch.from_arrays(columns, names=["sample", "bucket", "n"])
            held.clear()

        for batch in batches:
            kind = batch.column("sample").type
            names = batch.column("sample").dictionary_encode()
            own = names.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            units, row, at = _places(batch.column("seq"), k, first)
            bucket = _buckets(units, at, k)
            for i, sample in enumerate(names.dictionary.to_pylist()):
                if sample not in held and len(held) >= HELD:
                    yield from rows()
                held[sample] = held.get(sample, 0) + np.bincount(bucket[own[row] == i], minlength=BUCKETS)
        yield from rows()

    return reads.mapInArrow(counted, schema).groupBy("sample", "bucket").agg(F.sum("n").alias("n"))


def kmer_counts(reads: DataFrame, k: int, first: int) -> DataFrame:
    """sample, kmer and the number of rows that hold it from place ``first`` on, of the k-mers in the row's ``buckets``.

    All rows of a sample have the same ``buckets``.
    """
    ship(reads.sparkSession)
    schema = StructType([reads.schema["sample"]]).add("kmer", StringType()).add("n", LongType())

    def counted(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            names = batch.column("sample").dictionary_encode()
            own = names.indices.to_numpy(zero_copy_only=False)
            units, row, at = _places(batch.column("seq"), k, first)
            wanted = np.zeros((len(names.dictionary), BUCKETS), bool)
            for i, one in enumerate(np.unique(own, return_index=True)[1]):
                wanted[own[one], batch.column("buckets")[int(one)].as_py()] = True
            kept = wanted[own[row], _buckets(units, at, k)]
            row, at = row[kept], at[kept]
            windows = np.ascontiguousarray(units[at[:, None] + np.arange(k)])
            if units.dtype == np.uint8:
                ends = pa.py_buffer(np.arange(0, (len(at) + 1) * k, k, dtype=np.int32))
                text = pa.StringArray.from_buffers(len(at), ends, pa.py_buffer(windows))
            else:
                text = pa.array([w.tobytes().decode("utf-32-le") for w in windows], pa.string())
            # Once a row, then added up for the batch.
            once = pa.table({"row": row, "kmer": text}).group_by(["row", "kmer"]).aggregate([])
            found = pa.table({"sample": batch.column("sample").take(once.column("row").combine_chunks()), "kmer": once.column("kmer")})
            summed = found.group_by(["sample", "kmer"]).aggregate([([], "count_all")])
            columns = [summed.column(c).combine_chunks() for c in ("sample", "kmer", "count_all")]
            yield pa.RecordBatch.from_arrays(columns, names=["sample", "kmer", "n"])

    return reads.mapInArrow(counted, schema).groupBy("sample", "kmer").agg(F.sum("n").alias("reads"))
