"""Row numbers over a whole table without one global window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .staging import join_side, stage

# monotonically_increasing_id keeps the partition number above this bit.
_PARTITION_SHIFT = 33


def ranked(df: DataFrame, order: Sequence[Column | str], name: str = "rank", by: str | None = None) -> DataFrame:
    """Number rows 1..n in ``order``; with ``by`` the numbering starts anew per value.

    ``by`` is sorted first. The sort is range-partitioned, each row gets its place
    within its partition, and the partition sizes (one row per partition) give the
    offsets, so no task sees more than its range even if one ``by`` value dominates.
    The sorted rows are written first: offsets and places must come from one run.
    """
    keys = ([F.col(by)] if by else []) + [F.col(o) if isinstance(o, str) else o for o in order]
    placed = stage(df.orderBy(*keys).withColumn("_place", F.monotonically_increasing_id()), "ranked")
    placed = placed.withColumn("_part", F.shiftright("_place", _PARTITION_SHIFT)).withColumn(
        "_row", F.col("_place").bitwiseAND((1 << _PARTITION_SHIFT) - 1)
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part").agg(F.count("*").alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    # At most one row per partition of the sort: bounded by the partition count.
    out = placed.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_offset") + F.col("_row") + 1)
    if by:
        # Where each value begins: the rows of smaller values, from one row a partition and value.
        starts = placed.groupBy(F.col(by)).agg(F.count("*").alias("_n"))
        first = stage(
            starts.select(by, F.coalesce(F.sum("_n").over(Window.orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_first")),
            "ranked-starts",
        )
        out = out.join(join_side(first, first.count(), 64), by).withColumn(name, F.col(name) - F.col("_first"))
    return out.select(*df.columns, F.col(name).cast("bigint").alias(name))
