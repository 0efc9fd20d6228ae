"""Sharding by Hilbert-curve order.

Each metadata dimension is quantised to a few bits. Text dimensions are cut at equal
shares of the rows in code point order, the size on a logarithmic scale. The cells of
the grid are ordered along a Hilbert curve, documents are sorted by curve index, and the
sorted run is cut where the running sum of bytes passes each shard's share. Neighbours on
the curve are neighbours in every dimension, so each shard spans a small box and a filter
on any of the dimensions skips most shards.

Shares are equal to within one document: a document goes to the shard that holds its
middle byte.

Defined results: a null text has size 1 and the checksum of no bytes. A null value of a
text dimension is a value of its own, after all others. A null id sorts first in its
cell; repeated rows lie side by side and each has its own slot. No rows give no shards.
Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import join_small, source_key, stage, text_of

BITS = 5
PART_SHIFT = 33  # monotonically_increasing_id keeps the partition number above this bit


def hilbert_index(coordinates: Sequence[Column], bits: int = BITS) -> Column:
    """Position on the Hilbert curve of a grid with 2**bits cells a side.

    Per level, from the coarsest, the cell's bits are turned into the frame of the
    current sub-cube (entry corner and direction), read as a Gray code, and give the
    frame of the next level.
    """
    n = len(coordinates)
    full = (1 << n) - 1

    def gray(i: int) -> int:
        return i ^ (i >> 1)

    def trailing_ones(i: int) -> int:
        return (~i & (i + 1)).bit_length() - 1

    entries = [0 if w == 0 else gray(2 * ((w - 1) // 2)) for w in range(1 << n)]
    turns = [0 if w == 0 else trailing_ones(w - 1 + w % 2) % n for w in range(1 << n)]
    ranks = [0] * (1 << n)
    for w in range(1 << n):
        ranks[gray(w)] = w

    table = lambda v: F.array(*[F.lit(x) for x in v])
    # Rotations by every amount, so that a level is a lookup: [by][value].
    right = table([((v >> k) | (v << (n - k))) & full for k in range(n) for v in range(1 << n)])
    left = table([((v << k) | (v >> (n - k))) & full for k in range(n) for v in range(1 << n)])

    def look(values: Column, i: Column) -> Column:
        return F.get(values, i.cast("int"))

    def level(state: Column, shift: Column) -> Column:
        corner = sum(
            (F.call_function("shiftright", c.cast("int"), shift).bitwiseAND(F.lit(1)) * (1 << i)
             for i, c in enumerate(coordinates)), F.lit(0),
        )
        by = (state["turn"] + 1) % n
        seen = look(right, by * (1 << n) + corner.bitwiseXOR(state["entry"]))
        return F.struct(
            (state["index"] * (1 << n) + look(table(ranks), seen)).cast("bigint").alias("index"),
            state["entry"].bitwiseXOR(look(left, by * (1 << n) + look(table(entries), look(table(ranks), seen)))).cast("int").alias("entry"),
            ((state["turn"] + look(table(turns), look(table(ranks), seen)) + 1) % n).cast("int").alias("turn"),
        )

    start = F.struct(F.lit(0).cast("bigint").alias("index"), F.lit(0).alias("entry"), F.lit(0).alias("turn"))
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), start, level, lambda s: s["index"])


def share_codes(rows: DataFrame, column: str, bits: int = BITS) -> tuple[DataFrame, int]:
    """Code of every value of ``column``: its place among equal shares of all rows.

    One row per distinct value is sorted in one task; also gives their number.
    """
    running = Window.orderBy(column).rowsBetween(Window.unboundedPreceding, -1)
    counted = rows.groupBy(column).agg(F.count("*").alias("n"))
    codes = stage(
        counted.select(
            column,
            F.floor(F.coalesce(F.sum("n").over(running), F.lit(0)) * (1 << bits) / F.sum("n").over(Window.partitionBy()))
            .cast("int").alias(f"{column}_code"),
        ),
        "shard-codes",
    )
    return codes, codes.count()


def size_code(size: Column, bits: int = BITS) -> Column:
    """Two steps per doubling of the size, up to the last code."""
    return F.least(F.floor(F.log2(size.cast("double")) * 2), F.lit((1 << bits) - 1)).cast("int")


def described(docs: DataFrame) -> DataFrame:
    """Id, size, checksum and dimensions of every document."""
    text = text_of(docs)
    return docs.select(
        docs["doc_id"].cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        source_key(docs["source"]).alias("source"), source_key(docs["lang"]).alias("lang"),
    )


def on_curve(rows: DataFrame, dimensions: Sequence[str] = ("source", "lang"), bits: int = BITS) -> DataFrame:
    """Add ``curve``, the Hilbert index over the text dimensions and the size."""
    out = rows
    for name in dimensions:
        codes, count = share_codes(rows, name, bits)
        out = join_small(out, codes, [name], count)
    axes = [F.col(f"{name}_code") for name in dimensions] + [size_code(F.col("size"), bits)]
    return out.withColumn("curve", hilbert_index(axes, bits)).drop(*[f"{name}_code" for name in dimensions])


def running_totals(df: DataFrame, order: Sequence[str], amount: str) -> DataFrame:
    """Add ``rank`` from 0 and ``before``, the sum of ``amount`` over all earlier rows.

    The range-partitioned rows are written, so that places and partition sums come from
    one run; sums of partitions, one row each, give the offsets.
    """
    placed = stage(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "shard-sorted")
    placed = placed.withColumn("_part", F.shiftright("_place", PART_SHIFT))
    sums = stage(placed.groupBy("_part").agg(F.count("*").alias("_rows"), F.sum(amount).alias("_sum")), "shard-parts")
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rank"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"),
    )
    inside = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    return (
        join_small(placed.withColumn("_in", F.coalesce(F.sum(amount).over(inside), F.lit(0))), offsets, ["_part"], sums.count())
        .withColumn("rank", F.col("_rank") + F.col("_place").bitwiseAND((1 << PART_SHIFT) - 1))
        .withColumn("before", F.col("_base") + F.col("_in"))
        .select(*df.columns, "rank", "before")
    )


def sharded(docs: DataFrame, shards: int = 16, bits: int = BITS) -> DataFrame:
    """Shard and slot of every document, with its size, checksum and place on the curve."""
    rows = stage(described(docs), "shard-rows")
    run = stage(running_totals(on_curve(rows, bits=bits), ["curve", "doc_id", "size", "text_crc32"], "size"), "shard-run")
    total = run.agg(F.coalesce(F.sum("size"), F.lit(1))).first()[0]
    cut = run.withColumn(
        "shard", F.expr(f"least(({2 * shards} * before + {shards} * size) div {2 * total}, {shards - 1})").cast("int")
    )
    first = cut.groupBy("shard").agg(F.min("rank").alias("first"))  # one row a shard
    return cut.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("rank") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


def pruning_bounds(docs: DataFrame, placed: DataFrame) -> DataFrame:
    """Smallest and largest value of every dimension per shard, for skipping shards.

    ``placed`` is a result of ``sharded`` over the same documents with unique ids.
    """
    facts = described(docs).select("doc_id", F.substring("source", 2, 1 << 30).alias("source"), F.substring("lang", 2, 1 << 30).alias("lang"))
    return placed.select("doc_id", "shard", "size").join(facts, "doc_id").groupBy("shard").agg(
        F.count("*").alias("rows"), F.sum("size").alias("bytes"),
        *[f(c).alias(f"{name}_{c}") for c in ("source", "lang", "size") for name, f in (("min", F.min), ("max", F.max))],
    )


def write_shards(docs: DataFrame, placed: DataFrame, path: str) -> None:
    """Write the documents, one folder a shard, rows in slot order."""
    out = docs.join(placed.select("doc_id", "shard", "slot"), "doc_id")
    out.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
