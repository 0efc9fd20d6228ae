"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the word budget by its weight. A source whose share is
above its cap (``max_epochs`` times its own words) stays at the cap, and what it leaves
is shared among the others by weight, until no source is above its cap. That fixed
point is ``min(cap, level * weight)`` for one common level, which follows from prefix
sums over the sources in the order of cap / weight.

A source then gives every document whole repetitions and some documents one more. Those
are the first in the order of a seeded hash of id and text, up to the row at which the
running sum of words is nearest to the rest of the target. Rows equal in source, id and
text stand together in that order and count as one entry with a number of copies, so the
cut may fall inside them: then some of the copies are taken once more. The running sum
comes from sums over hash buckets; only the distinct entries of the bucket that holds the
cut are sorted, and only copies of the one entry at the cut are numbered, a task each.

Defined results: a null text has no words. A null source is a source of its own, after
all others. Null and repeated ids are rows like others: a source misses its target by half
of the size of the row at the cut at most. Which of several equal rows is taken once more
does not matter and is not fixed; how many are, is. Documents without words take 0. No rows
give no rows. Other columns are kept and may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import count_words, join_small, source_key, stage, text_of
from .ordering import any_places

BUCKET_DIGITS = 3  # hex digits of the hash: 4,096 buckets a source


def cyclic_weights(weights: Sequence[float]):
    """Weights that repeat over the sources in code point order, null last."""
    values = F.array(*[F.lit(float(w)) for w in weights])

    def weight(place: Column) -> Column:
        return F.element_at(values, ((place - 1) % len(weights) + 1).cast("int"))

    return weight


def water_fill(sources: DataFrame, weight, budget_share: float, max_epochs: float) -> DataFrame:
    """``sources(skey, source_size)`` with the ``target`` words of each.

    One row per source, so the windows over all of them stay small.
    """
    everything = Window.partitionBy()
    named = sources.select(
        "skey", "source_size",
        weight(F.row_number().over(Window.orderBy("skey"))).alias("weight"),
        (F.sum("source_size").over(everything) * F.lit(float(budget_share))).alias("budget"),
    ).withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    filled = Window.orderBy(F.col("cap") / F.col("weight"), "skey").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("budget") - F.coalesce(F.sum("cap").over(filled), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filled), F.lit(0.0))
    )
    return (
        named.withColumn("level", level)
        .withColumn("target", F.least("cap", F.max("level").over(everything) * F.col("weight")))
        .select("skey", "source_size", "target")
    )


def seeded_place(docs: DataFrame, seed: str) -> Column:
    """Place of a row in the seeded order: a hash of its id and its text."""
    doc = F.coalesce(docs["doc_id"].cast("string"), F.lit("null"))
    return F.md5(F.concat(F.lit(seed + ":"), doc, F.lit(":"), F.md5(text_of(docs))))


def sized(docs: DataFrame, seed: str) -> DataFrame:
    """Id, source key, words and place in the seeded order of every document."""
    return docs.select(
        docs["doc_id"].alias("doc_id"), source_key(docs["source"]).alias("skey"), count_words(text_of(docs)).alias("size"),
        seeded_place(docs, seed).alias("place"),
    )


def plan_mixture(measured: DataFrame, weight, budget_share: float, max_epochs: float) -> tuple[DataFrame, int]:
    """Per source: size, target, whole repetitions, the entry at the cut and how many of its copies get one more.

    ``measured`` is a written table like that of ``sized``. ``copies`` is null where all of
    them do. Also gives the number of sources.
    """
    bucket = F.substring("place", 1, BUCKET_DIGITS).alias("bucket")
    sums = stage(measured.groupBy("skey", bucket).agg(F.sum("size").alias("words")), "mix-buckets")
    targets = stage(
        water_fill(sums.groupBy("skey").agg(F.sum("words").alias("source_size")), weight, budget_share, max_epochs)
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")),
        "mix-targets",
    )
    count = targets.count()
    running = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
    edges = stage(
        join_small(starts, targets, ["skey"], count).filter(
            (F.col("before") < F.col("rest")) & (F.col("rest") <= F.col("before") + F.col("words"))
        ).select("skey", "bucket", "before", "rest"),
        "mix-edges",
    )
    inside = join_small(measured.withColumn("bucket", bucket), edges, ["skey", "bucket"], count)
    entries = inside.filter("size > 0").groupBy("skey", "bucket", "before", "rest", "place", "size").agg(F.count("*").alias("m"))
    within = Window.partitionBy("skey", "bucket").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    # A copy is taken while the sum up to its middle is below the rest; the division finds the
    # number of such copies up to rounding, the comparison settles it.
    middle = lambda c: F.col("sum") + c * F.col("size") + F.col("size") / 2
    near = F.greatest(F.floor((F.col("rest") - F.col("sum")) / F.col("size") - 0.5), F.lit(0))
    last = (
        entries.withColumn("sum", F.col("before") + F.coalesce(F.sum(F.col("size") * F.col("m")).over(within), F.lit(0)))
        .withColumn("near", near)
        .withColumn("j", F.least(F.col("near") + F.when(middle(F.col("near")) < F.col("rest"), 1).otherwise(0), F.col("m")))
        .filter("j > 0").groupBy("skey").agg(F.max_by(F.struct("place", F.when(F.col("j") < F.col("m"), F.col("j")).alias("copies")), "place").alias("last"))
        .select("skey", F.col("last.place").alias("last"), F.col("last.copies").alias("copies"))
    )
    cut = edges.select("skey", F.col("bucket").alias("edge"))
    # Without an entry in the edge bucket the cut lies before the bucket.
    plan = join_small(join_small(targets, last, ["skey"], count, how="left"), cut, ["skey"], count, how="left").select(
        "skey", "source_size", "target", "whole", F.coalesce("last", "edge", F.lit("")).alias("cut"), "copies"
    )
    return stage(plan, "mix-plan"), count


def _repeats(place: Column, whole: Column, cut: Column) -> Column:
    return (whole + F.when(place <= cut, 1).otherwise(0)).cast("int")


def mixture(docs: DataFrame, weight=None, budget_share: float = 1.5, max_epochs: float = 2.0, seed: str = "mix") -> DataFrame:
    """Every document with ``size``, its source's size and target, and its ``repeats``."""
    measured = stage(sized(docs, seed), "mix-sized")
    plan, count = plan_mixture(measured, weight or cyclic_weights((5, 2, 1)), budget_share, max_epochs)
    return _with_repeats(measured, plan, count)


def _with_repeats(rows: DataFrame, plan: DataFrame, count: int) -> DataFrame:
    """``rows`` (skey, place and others) with the columns of the plan and ``repeats``."""
    split = plan.filter("copies is not null")
    joined = join_small(rows, plan, ["skey"], count)
    at_cut = F.col("copies").isNotNull() & (F.col("place") == F.col("cut"))
    out = joined.filter(~at_cut).withColumn("repeats", _repeats(F.col("place"), F.col("whole"), F.col("cut"))).drop("copies")
    if split.isEmpty():
        return out
    # Copies of one entry a source: numbered where they are, without a sort.
    copies = any_places(joined.filter(at_cut), "skey", "mix-copies")
    taken = (F.col("whole") + F.when(F.col("at") < F.col("copies"), 1).otherwise(0)).cast("int")
    return out.unionByName(copies.withColumn("repeats", taken).drop("copies", "at", "n"))


def mixed_documents(docs: DataFrame, weight=None, budget_share: float = 1.5, max_epochs: float = 2.0, seed: str = "mix") -> DataFrame:
    """The mix itself: every document as often as it is taken, with its own columns."""
    measured = stage(sized(docs, seed), "mix-sized")
    plan, count = plan_mixture(measured, weight or cyclic_weights((5, 2, 1)), budget_share, max_epochs)
    own = F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)])
    rows = docs.select(source_key(docs["source"]).alias("skey"), seeded_place(docs, seed).alias("place"), own.alias("own"))
    taken = _with_repeats(rows, plan.drop("source_size", "target"), count).filter("repeats > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("repeats")))).select(
        *[F.col(f"own.c{i}").alias(c) for i, c in enumerate(docs.columns)]
    )


def oracle_sql() -> str:
    size = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"
    return rf"""
with d as (
  select doc_id, case when source is null then 'b' else 'a' || source end skey, {size} size,
         md5('mix:' || coalesce(cast(doc_id as varchar), 'null') || ':' || md5(coalesce(text, ''))) place from documents),
s as (select skey, cast(sum(size) as bigint) source_size from d group by skey),
w as (select *, [5.0::double, 2.0::double, 1.0::double][(row_number() over (order by skey) - 1) % 3 + 1] weight,
             cast(sum(source_size) over () as double) * 1.5::double budget, source_size * 2.0::double cap from s),
l as (select *, (budget - coalesce(sum(cap) over f, 0.0::double)) / (sum(weight) over () - coalesce(sum(weight) over f, 0.0::double)) lev
      from w window f as (order by cap / weight, skey rows between unbounded preceding and 1 preceding)),
t as (select skey, source_size, least(cap, max(lev) over () * weight) target from l),
r as (select *, case when source_size > 0 then floor(target / source_size) else 0 end whole from t),
p as (select d.*, r.source_size, r.target, r.whole, r.target - r.whole * r.source_size rest,
             coalesce(sum(size) over (partition by d.skey order by place rows between unbounded preceding and 1 preceding), 0) before
      from d join r on d.skey = r.skey)
select doc_id, cast(size as bigint) size, source_size, target,
       cast(size * (whole + case when before + size / 2 < rest then 1 else 0 end) as bigint) taken
from p
"""
