"""Approximate nearest neighbours by a forest of hash-prefix trees.

A tree gives every vector a long string of bits, the signs of its projections on random
orthogonal directions; equal vectors are one point with its smallest ids. The points are
dealt into blocks of bounded size, and each block keeps one sorted array of strings per
tree. A query descends in all arrays to its longest common prefixes, then all trees
ascend together, one bit at a time, until the points under the prefixes, counted per
tree, are at least ``share`` times the block. Those points, a variable number with no cap, are ranked by their exact
distance, and the best of all blocks are merged.

The share sets the recall. Random high-dimensional vectors without structure need a
large one; it is a parameter, and the recall against brute force is tested.

A block never holds more than about ``BLOCK`` points, a task not more than one block and
``QUERY_CHUNK`` queries, whatever vectors are repeated.

Defined results: rows with a null id, a null, empty or zero vector, or a component that
is null or not finite take no part. Vectors of another length than the query's are not
its candidates. Rows equal in id and vector count once; other rows with the query's id are not
its candidates. Ties go to the smaller id. Fewer candidates than ``k`` give fewer rows,
no rows none. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import join_small, ship, stage

TREES = 128
BITS = 20
SHARE = 1.0
BLOCK = 8192
QUERY_CHUNK = 1024
SEED = 11


def usable(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    v = F.transform(vectors[column], lambda x: x.cast("double"))
    rows = vectors.select(vectors[id_column].cast("bigint").alias("id"), v.alias("vector"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return rows.filter(
        F.col("id").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", finite) & F.exists("vector", lambda x: x != 0)
    )


def points_of(rows: DataFrame, k: int) -> DataFrame:
    """Distinct vectors with a number, their length and their ``k + 1`` smallest ids."""
    place = Window.partitionBy("vector").orderBy("id")
    few = rows.distinct().withColumn("place", F.row_number().over(place)).filter(F.col("place") <= k + 1)
    return few.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(
        F.monotonically_increasing_id().alias("point"), "vector", F.size("vector").alias("dim"), "ids"
    )


def directions(dim: int, trees: int, bits: int, seed: int) -> np.ndarray:
    """``bits`` directions a tree, orthogonal as far as the dimension allows."""
    rng = np.random.default_rng(seed)
    out = rng.standard_normal((trees, dim, bits))
    for begin in range(0, bits, dim):
        out[:, :, begin : begin + dim] = np.linalg.qr(out[:, :, begin : begin + dim])[0]
    return out


class Forest:
    """Sorted arrays of hash strings over one block of points."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = SEED):
        self.vectors, self.bits = vectors, bits
        self.planes = directions(vectors.shape[1], trees, bits, seed)
        self.middle = vectors.mean(axis=0)
        keys = self.strings(vectors)
        self.order = np.argsort(keys, axis=1, kind="stable")
        self.sorted = np.take_along_axis(keys, self.order, axis=1)

    def strings(self, vectors: np.ndarray) -> np.ndarray:
        weights = 1 << np.arange(self.bits - 1, -1, -1, dtype=np.int64)
        centred = vectors - self.middle
        return np.stack([((centred @ p) > 0) @ weights for p in self.planes])

    def under(self, keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end, in every tree's array, of the strings that share ``level`` bits with each key."""
        low = (keys >> (self.bits - level)) << (self.bits - level)
        high = low + (1 << (self.bits - level))
        begin = np.stack([np.searchsorted(s, x) for s, x in zip(self.sorted, low)])
        end = np.stack([np.searchsorted(s, x) for s, x in zip(self.sorted, high)])
        return begin, end

    def candidates(self, queries: np.ndarray, wanted: int):
        """Point numbers for each query: ascend in all trees until ``wanted`` are under the prefixes."""
        keys = self.strings(queries)
        open_ = np.arange(len(queries))
        found: list = [None] * len(queries)
        for level in range(self.bits, -1, -1):
            begin, end = self.under(keys[:, open_], level)
            enough = (end - begin).sum(axis=0) >= wanted if level else np.ones(len(open_), bool)
            for i in np.flatnonzero(enough):
                hit = np.zeros(len(self.vectors), bool)
                for order, b, e in zip(self.order, begin[:, i], end[:, i]):
                    hit[order[b:e]] = True
                found[open_[i]] = np.flatnonzero(hit)
            open_ = open_[~enough]
            if not len(open_):
                break
        return found


FOUND = "query bigint, point bigint, distance double, least bigint"


def block_search(part: pd.DataFrame, k: int, trees: int, bits: int, share: float, seed: int) -> pd.DataFrame:
    """The ``k`` nearest points of one block for each query of one chunk."""
    asked = part["query"].to_numpy(bool)
    index, queries = part[~asked], part[asked]
    out = []
    if len(index) and len(queries):
        vectors, wanted = np.stack(index["vector"].tolist()), np.stack(queries["vector"].tolist())
        points, least = index["point"].to_numpy(), index["least"].to_numpy()
        forest = Forest(vectors, trees, bits, seed)
        for q, v, near in zip(queries["point"], wanted, forest.candidates(wanted, int(np.ceil(share * len(index))))):
            distance = np.sqrt(((vectors[near] - v) ** 2).sum(axis=1))
            best = np.lexsort((least[near], distance))[:k]
            out.append(pd.DataFrame({"query": q, "point": points[near[best]], "distance": distance[best], "least": least[near[best]]}))
    return pd.concat(out) if out else pd.DataFrame({"query": [], "point": [], "distance": [], "least": []}).astype(
        {"query": "int64", "point": "int64", "least": "int64"}
    )


def nearest(
    vectors: DataFrame, every: int = 100, k: int = 10, id_column: str = "vec_id", column: str = "embedding",
    trees: int = TREES, bits: int = BITS, share: float = SHARE, block: int = BLOCK, seed: int = SEED,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest found for rows whose id is divisible by ``every``."""
    ship(vectors.sparkSession)
    rows = usable(vectors, id_column, column)
    points = stage(points_of(rows, k), "ann-points")
    asks = stage(
        rows.filter(F.col("id") % every == 0).distinct().join(points.select("point", "vector"), "vector")
        .select(F.col("id").alias("query_id"), "point"), "ann-queries",
    )
    n_points = points.count()
    asked = asks.select("point").distinct()
    n_asked = asked.count()
    blocks, chunks = max(1, -(-n_points // block)), max(1, -(-n_asked // QUERY_CHUNK))
    place = lambda salt, n: F.pmod(F.xxhash64("point", F.lit(salt)), F.lit(n)).cast("int")
    every_one = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    columns = ["point", "dim", "vector", F.get("ids", F.lit(0)).alias("least")]
    index = points.select(*columns, F.lit(False).alias("query"), place(1, blocks).alias("block"), every_one(chunks).alias("chunk"))
    queries = points.join(asked, "point", "left_semi").select(
        *columns, F.lit(True).alias("query"), every_one(blocks).alias("block"), place(2, chunks).alias("chunk")
    )
    # One task for a block and a chunk of queries; a point more than k, as the query itself is one.
    found = index.union(queries).groupBy("dim", "block", "chunk").applyInPandas(
        lambda part: block_search(part, k + 1, trees, bits, share, seed), FOUND
    )
    best = Window.partitionBy("query").orderBy("distance", "least")
    near = stage(found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1).drop("place"), "ann-near")
    members = near.join(points.select("point", F.explode("ids").alias("vec_id")), "point")
    by_rank = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    return (
        asks.join(members, asks["point"] == members["query"]).filter("query_id <> vec_id")
        .withColumn("rank", F.row_number().over(by_rank)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", F.col("distance").alias("score"))
    )
