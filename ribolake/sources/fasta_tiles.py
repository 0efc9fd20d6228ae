"""FASTA as tiles: one record, a chromosome say, is read by as many tasks as it has splits.

Plain files are split by byte range wherever that falls, also inside a line. A task looks back
for the beginning of the line it starts in, so it knows whether it is in a header or among bases,
and gives the bases of each stretch with the header it has seen, or none where the record began
in an earlier split. Which record such a stretch continues, and at which base, comes from sums
over one row a split. Gzip files are one split each.
"""

from __future__ import annotations

import gzip
import io
import json
import sys
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.staging import join_side, stage
from . import fastq as files

SCHEMA = "path string, split bigint, record_at bigint, header string, at bigint, bases binary"
BLOCK_BYTES = 4 << 20
CHUNK_BASES = 65_536
BATCH_ROWS = 1024
# Fixed value: characters that are no bases wherever they stand.
WHITE = b" \t\r\n\x0b\x0c"


@dataclass
class FastaSplit(InputPartition):
    path: str
    start: int
    end: int | None


def _line_start(handle, start: int) -> int:
    """Where the line begins that the byte at ``start`` belongs to."""
    at = start
    while at > 0:
        low = max(0, at - BLOCK_BYTES)
        handle.seek(low)
        found = handle.read(at - low).rfind(b"\n")
        if found >= 0:
            return low + found + 1
        at = low
    return 0


def _stretches(handle, start: int, end: int | None):
    """(record_at, header, at, bases) of the bytes from ``start`` to ``end``, in order.

    A header belongs to the split it begins in and is read on beyond the end. Bases come in
    chunks; a record without bases in this split still gives one empty chunk.
    """
    position, fresh = start, True
    if start > 0:
        line = _line_start(handle, start)
        handle.seek(line)
        fresh = line == start
        if not fresh and handle.read(1) == b">":
            handle.seek(start)
            position += len(handle.readline())
            fresh = True
        handle.seek(position)
    record, header, at, opened, shown = None, None, 0, None, True
    while end is None or position < end:
        data = handle.read(BLOCK_BYTES if end is None else min(BLOCK_BYTES, end - position))
        if not data:
            break
        where = 0
        while where < len(data):
            if opened is not None:
                stop = data.find(b"\n", where)
                opened += data[where:] if stop < 0 else data[where:stop]
                if stop < 0:
                    break
                header, opened, where, fresh = opened, None, stop + 1, True
            elif fresh and data[where] == ord(">"):
                if not shown:
                    yield record, header, at, b""
                record, header, at, opened, shown, fresh = position + where, None, 0, b"", False, False
                where += 1
            else:
                stop = data.find(b"\n>", where) + 1 or len(data)
                bases = data[where:stop].translate(None, WHITE)
                for i in range(0, len(bases), CHUNK_BASES):
                    part = bases[i : i + CHUNK_BASES]
                    yield record, header, at, part
                    at, shown = at + len(part), True
                fresh, where = data[stop - 1] == ord("\n"), stop
        position += len(data)
    if opened is not None:
        header = opened + handle.readline()
    if not shown:
        yield record, header, at, b""


class FastaReader(DataSourceReader):
    def __init__(self, options):
        self.files = json.loads(options["files"])
        self.split_bytes = int(options.get("splitBytes", 32 << 20))

    def partitions(self):
        out = []
        for path, size in self.files:
            if path.endswith(".gz"):
                out.append(FastaSplit(path, 0, None))
            else:
                out += [FastaSplit(path, a, min(a + self.split_bytes, size)) for a in range(0, size, self.split_bytes)]
        return out

    def read(self, split):
        if split is None:  # no file, or only empty ones
            return
        system, inner = files._open(split.path)
        text = lambda value: None if value is None else value.decode("utf-8", errors="replace")
        with system.open_input_file(inner) as raw:
            handle = io.BufferedReader(gzip.GzipFile(fileobj=raw) if inner.endswith(".gz") else raw)
            rows: list[tuple] = []
            size = 0

            def batch():
                record, header, at, bases = (list(c) for c in zip(*rows))
                return pa.RecordBatch.from_arrays([
                    pa.array([split.path] * len(rows), pa.string()), pa.array([split.start] * len(rows), pa.int64()),
                    pa.array(record, pa.int64()), pa.array(map(text, header), pa.string()), pa.array(at, pa.int64()), pa.array(bases, pa.binary()),
                ], names=["path", "split", "record_at", "header", "at", "bases"])

            for row in _stretches(handle, split.start, split.end):
                rows.append(row)
                size += len(row[3])
                if len(rows) == BATCH_ROWS or size >= BLOCK_BYTES:
                    yield batch()
                    rows, size = [], 0
            if rows:
                yield batch()


class FastaSource(DataSource):
    @classmethod
    def name(cls):
        return "fasta_stretches"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return FastaReader(self.options)


def _stretch_table(spark: SparkSession, paths: str | list[str], split_bytes: int | None) -> DataFrame:
    listed = [f for path in ([paths] if isinstance(paths, str) else paths) for f in files.listed(spark, path)]
    for module in (sys.modules[__name__], files):
        cloudpickle.register_pickle_by_value(module)
    spark.dataSource.register(FastaSource)
    reader = spark.read.format("fasta_stretches").option("files", json.dumps(listed))
    return (reader.option("splitBytes", str(split_bytes)) if split_bytes else reader).load()


def _continued(stretches: DataFrame) -> DataFrame:
    """For each split: the record open at its beginning, that record's header, and how many of its bases came before.

    One row a split, so the window over the splits of one file is small.
    """
    size = F.length("bases")
    pieces = stretches.groupBy("path", "split", "record_at").agg(F.max("header").alias("header"), F.sum(size).alias("size"))
    splits = pieces.groupBy("path", "split").agg(
        F.max("record_at").alias("newest"), F.max_by("header", "record_at").alias("header"),
        F.coalesce(F.max_by("size", "record_at"), F.sum("size")).alias("tail"),
    )
    before = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    summed = splits.withColumn("before", F.coalesce(F.sum("tail").over(before), F.lit(0)))
    owner = F.when(F.col("newest").isNotNull(), F.struct("newest", "header", "before"))
    opened = summed.withColumn("owner", F.last(owner, ignorenulls=True).over(before))
    return opened.select(
        "path", "split", F.col("owner.newest").alias("open_at"), F.col("owner.header").alias("open_header"),
        (F.col("before") - F.col("owner.before")).alias("open_bases"),
    )


def read_fasta_tiles(spark: SparkSession, paths: str | list[str], tile: int = 4096, split_bytes: int | None = None) -> DataFrame:
    """(ref_id, description, path, record_at, tile, start, seq): the bases of each record in tiles of ``tile``.

    ``start`` is the first base's place in the record, from 0; ``record_at`` is the header's byte in its (unzipped)
    file, so records of one id stay apart. A record without bases has one empty tile. Lines before the first
    header of a file belong to no record and are left out. No row or task holds more of a record than a split.
    """
    stretches = stage(_stretch_table(spark, paths, split_bytes), "fasta")
    opened = stage(_continued(stretches), "fasta-splits")
    placed = stretches.join(join_side(opened, opened.count(), 512), ["path", "split"])
    own = F.col("record_at").isNotNull()
    begin = F.when(own, F.col("at")).otherwise(F.col("at") + F.col("open_bases"))
    placed = placed.select(
        "path", F.coalesce("record_at", "open_at").alias("record_at"),
        F.when(own, F.col("header")).otherwise(F.col("open_header")).alias("header"), begin.alias("begin"),
        "bases", F.length("bases").alias("size"),
    ).filter("record_at is not null")
    last = F.greatest(F.col("begin"), F.col("begin") + F.col("size") - 1)
    low = lambda t: F.greatest(t * tile, F.col("begin"))
    cut = lambda t: F.struct(
        t.alias("tile"), low(t).alias("from"),
        F.substring("bases", (low(t) - F.col("begin") + 1).cast("int"), (t * tile + tile - low(t)).cast("int")).alias("part"),
    )
    tiles = F.sequence(F.floor(F.col("begin") / tile), F.floor(last / tile))
    parts = placed.select("path", "record_at", "header", F.inline(F.transform(tiles, cut)))
    # The parts of one tile hold no more than its bases.
    joined = parts.groupBy("path", "record_at", "tile").agg(
        F.max("header").alias("header"), F.sort_array(F.collect_list(F.struct("from", "part"))).alias("parts")
    )
    name = F.trim(F.regexp_replace("header", "[\r\n]+$", ""))
    return joined.select(
        F.regexp_extract(name, r"^(\S+)", 1).alias("ref_id"), F.trim(F.regexp_replace(name, r"^\S+", "")).alias("description"),
        "path", "record_at", "tile", (F.col("tile") * tile).alias("start"),
        F.array_join(F.transform("parts", lambda p: p["part"].cast("string")), "").alias("seq"),
    )
