"""Places of rows inside their groups, whatever the size of a group.

The rows are sorted once over all tasks, so one group may span many of them. What a task
holds of a group is counted, and the counts of one group, a row a task, give the offsets.
No task sees more than its range of the sort, and no window sees more of a group than one
row a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import join_small, stage

# monotonically_increasing_id keeps the partition number above this bit.
_SHIFT = 33


def sorted_rows(df: DataFrame, group: str, order: Sequence[str | Column], keep: Sequence[str], label: str) -> DataFrame:
    """``keep`` of the rows in the order of ``group`` and ``order``, written, with ``_part`` and ``_row``.

    Rows that tie in everything are dealt by their place in the input, so that a great many
    equal rows do not meet in one task; ``df`` should be a table as it is read.
    """
    tie = F.monotonically_increasing_id()
    placed = df.withColumn("_tie", tie).orderBy(group, *order, "_tie").select(
        *keep, F.monotonically_increasing_id().alias("_place")
    )
    return _by_task(stage(placed, label))


def _by_task(placed: DataFrame) -> DataFrame:
    return placed.withColumn("_part", F.shiftright("_place", _SHIFT)).withColumn(
        "_row", F.col("_place").bitwiseAND((1 << _SHIFT) - 1)
    ).drop("_place")


def any_places(df: DataFrame, group: str, label: str) -> DataFrame:
    """Number the rows of each group from 0 as ``at``, in any order, without moving them between tasks; ``n`` counts them."""
    placed = df.sortWithinPartitions(group).withColumn("_place", F.monotonically_increasing_id())
    rows = _by_task(stage(placed, label))
    return with_places(rows, starts(rows, group, f"{label}-starts"), group)


def starts(placed: DataFrame, group: str, label: str) -> DataFrame:
    """Per task and group: first row, rows of the group in earlier tasks, and all its rows as ``n``."""
    counts = placed.groupBy(group, "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_rows"))
    of_group = Window.partitionBy(group)
    earlier = of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return stage(
        counts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .withColumn("n", F.sum("_rows").over(of_group)).drop("_rows"), label,
    )


def with_places(placed: DataFrame, first: DataFrame, group: str, row_bytes: int = 128) -> DataFrame:
    """The sorted rows with ``at``, their place in the group from 0, and the columns of ``first``."""
    joined = join_small(placed, first, [group, "_part"], first.count(), row_bytes)
    return joined.withColumn("at", F.col("_row") - F.col("_first") + F.col("_before")).drop("_part", "_row", "_first", "_before")
