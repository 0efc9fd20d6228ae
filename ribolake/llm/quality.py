"""Quality classifier: hashed word n-grams, logistic regression, FTRL-proximal updates.

Tokens are lower-cased runs of letters and digits and runs of other marks, with one
token more where a word is in capitals. Features are hashed single tokens and pairs of
neighbours, as shares of the text scaled to unit length, so a score is one sparse dot
product. Texts are hashed as a whole and never cut.

Training takes at most ``max_train`` labelled rows (a stated bound: the smallest seeded
hashes of the ids, repeated ids as often as they occur until the bound is reached). The
sample is dealt over groups of about ``SHARD_ROWS`` rows, six at least; in each round
every group runs FTRL-proximal from the common state over its documents in hash order,
and the states (sums ``z`` and ``n`` of every feature) are averaged. The sample bounds a
group, the number of features a state.

Defined results: a null or empty text has the score of the intercept. Labels other than 0
and 1, null labels and contradictory labels of an id are not used; repeated labelled
documents train as often as they occur, within the sample. Without any label every score
is 0.5. Repeated rows get equal scores, a null id is scored and not held out. No
documents give no rows. ``source``, ``lang``, ids and labels are never features.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from . import textbatch
from .common import ship, stage, text_of
from .rules import usable_labels

BITS = 18
DIM = 1 << BITS
MAX_TRAIN = 12_000
SHARDS = 6
SHARD_ROWS = 2000
ROUNDS = 4
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.02, 0.05


def held_out(doc_id: Column) -> Column:
    """Remainder 1 of the id's checksum by 3; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per run of texts: first and end row, then text number, feature and value."""
    for first, end, raw, offsets in textbatch.chunks(column):
        words = textbatch.Words(raw, offsets, lower=True, split_marks=True)
        hashes, owner = words.hashes, textbatch.owners(words.bounds)
        if not len(hashes):
            yield first, end, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
            continue
        same = owner[1:] == owner[:-1]
        pairs = textbatch.mixed(hashes[:-1] * np.uint64(3) + hashes[1:])[same]
        upper = (raw >= 65) & (raw <= 90)
        letters = upper | ((raw >= 97) & (raw <= 122))
        size = np.add.reduceat(letters.astype(np.int32), words.starts)
        capital = (np.add.reduceat(upper.astype(np.int32), words.starts) == size) & (size > 1)
        marks = np.full(int(capital.sum()), 0x1234567, np.uint64)
        rows = np.concatenate([owner, owner[1:][same], owner[capital]])
        slots = (np.concatenate([hashes, pairs, textbatch.mixed(marks)]) >> np.uint64(64 - BITS)).astype(np.int64)
        key, count = np.unique(rows * DIM + slots, return_counts=True)
        row = key >> BITS
        norm = np.sqrt(np.bincount(row, count.astype(float) ** 2, end - first))
        yield first, end, row, key & (DIM - 1), count / norm[row]


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def weights_of(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights of a state: zero inside the L1 band. The intercept, last, is not shrunk."""
    l1 = np.full(len(z), L1)
    l1[-1] = 0.0
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def train_one(texts: pa.Array, labels: np.ndarray, z: np.ndarray, n: np.ndarray) -> None:
    """One pass of FTRL-proximal updates, document by document, in place."""
    for first, end, rows, slots, values in features(texts):
        bounds = np.searchsorted(rows, np.arange(end - first + 1))
        for i in range(end - first):
            at = np.append(slots[bounds[i] : bounds[i + 1]], DIM)
            x = np.append(values[bounds[i] : bounds[i + 1]], 1.0)
            w = weights_of(np.append(z[at], 0.0), np.append(n[at], 0.0))[:-1]
            w[-1] = -z[DIM] / ((BETA + np.sqrt(n[DIM])) / ALPHA + L2)
            g = (sigmoid(float(w @ x)) - labels[first + i]) * x
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g


def sample(docs: DataFrame, labels: DataFrame, max_train: int) -> DataFrame:
    """The bounded training sample: text, label, place and group.

    Rows are ranked, not ids: rows equal in id and text are counted first, and the running
    sum of the counts says how many of them are within the bound.
    """
    place = F.xxhash64(F.lit("train"), F.col("doc_id"))
    known = usable_labels(labels).filter(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    chosen = known.withColumn("place", place).orderBy("place", "doc_id").limit(max_train)  # ids only
    texts = docs.select(docs["doc_id"].alias("doc_id"), text_of(docs).alias("text")).withColumn("text_key", F.md5("text"))
    order = ["place", "doc_id", "text_key"]
    counted = texts.select("doc_id", "text_key").join(F.broadcast(chosen), "doc_id").groupBy(*order, "label").agg(F.count("*").alias("m"))
    # At most ``max_train`` rows of ids and counts.
    before = F.coalesce(F.sum("m").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    picked = stage(
        counted.orderBy(*order).limit(max_train).withColumn("copies", F.least("m", F.lit(max_train) - before))
        .filter("copies > 0").drop("m"), "quality-picked",
    )
    # Equal rows are reduced to one text map-side, then unfolded to the copies within the bound.
    once = texts.join(F.broadcast(picked), ["doc_id", "text_key"]).groupBy(*order, "label", "copies").agg(F.first("text").alias("text"))
    shards = max(SHARDS, -(-max_train // SHARD_ROWS))
    return once.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))).withColumn(
        "group", F.when(F.col("copies") == 1, F.pmod("place", F.lit(shards))).otherwise(F.pmod(F.xxhash64(*order, "copy"), F.lit(shards))).cast("int")
    ).drop("copies")


STATE = "group int, slot int, z double, n double"


def trained(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of all features and, last, the intercept."""
    chosen = stage(sample(docs, labels, max_train), "quality-sample")
    ship(docs.sparkSession)
    z, n = np.zeros(DIM + 1), np.zeros(DIM + 1)
    for _ in range(rounds):
        state = docs.sparkSession.sparkContext.broadcast((z, n))

        def run(part: pd.DataFrame) -> pd.DataFrame:
            own_z, own_n = (x.copy() for x in state.value)
            part = part.sort_values(["place", "doc_id", "text_key", "copy"])
            train_one(pa.array(part["text"], pa.large_string()), part["label"].to_numpy(float), own_z, own_n)
            slot = np.flatnonzero(own_n)
            return pd.DataFrame({"group": part["group"].iloc[0], "slot": slot.astype(np.int32), "z": own_z[slot], "n": own_n[slot]})

        # Averaged over the groups, a group without the feature counting as unchanged; added
        # up in the order of the groups, so that reruns agree to the last bit.
        added = lambda c: F.aggregate("states", F.lit(0.0), lambda s, e: s + e[c]).alias(c)
        found = chosen.groupBy("group").applyInPandas(run, STATE).groupBy("slot").agg(
            F.array_sort(F.collect_list(F.struct("group", "z", "n"))).alias("states")
        ).select("slot", added("z"), added("n"), F.size("states").alias("groups")).toArrow()  # at most one row a feature slot
        at, sum_z, sum_n, own = (found.column(c).to_numpy() for c in ("slot", "z", "n", "groups"))
        groups = max(int(own.max()), 1) if len(own) else 1
        z[at] = (sum_z + (groups - own) * z[at]) / groups
        n[at] = (sum_n + (groups - own) * n[at]) / groups
        state.unpersist()
    return weights_of(z, n)


def scorer(spark: SparkSession, weights: np.ndarray):
    """A column function from texts to scores; all other columns stay in the JVM."""
    ship(spark)
    shared = spark.sparkContext.broadcast(weights)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        w = shared.value
        out = np.full(len(texts), w[DIM])
        for first, end, rows, slots, values in features(texts):
            out[first:end] += np.bincount(rows, w[slots] * values, end - first)
        return pa.array(sigmoid(out))

    return score


def classified(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """Score and verdict of every document."""
    score = scorer(docs.sparkSession, trained(docs, labels, max_train))
    return docs.select(docs["doc_id"].alias("doc_id"), score(text_of(docs)).alias("score")).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_train: int = MAX_TRAIN) -> DataFrame:
    """The documents whose score reaches ``threshold``, with their own columns."""
    score = scorer(docs.sparkSession, trained(docs, labels, max_train))
    return docs.filter(score(text_of(docs)) >= threshold)
