"""Connected components of a link table, by alternating star contractions.

Every step is joins and aggregates over the links, written after each step. The number
of steps grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stage

MAX_STEPS = 60


def _both_ways(links: DataFrame) -> DataFrame:
    return links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the node's smallest neighbour."""
    both = _both_ways(links)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for all nodes in ``links(a, b)``."""
    tidy = lambda df: stage(df.filter("a <> b").distinct(), "links")
    links = tidy(links.select("a", "b"))
    before = _state(links)
    for _ in range(MAX_STEPS):
        if not before[0]:
            break
        links = tidy(_small_star(tidy(_large_star(links))))
        after = _state(links)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
