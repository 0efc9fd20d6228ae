import random

import pytest
from pyspark.sql import functions as F

from ribolake.operators import intervals as iv

SCHEMA = "contig string, start bigint, end bigint, strand string, name string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, f"n{i}") for i, r in enumerate(rows)], SCHEMA)


def some(rnd, n, contigs=3, size=3000, longest=90):
    out = []
    for _ in range(n):
        s = rnd.randrange(size)
        out.append((f"c{rnd.randrange(contigs)}", s, s + rnd.randint(1, longest), rnd.choice("+-")))
    return out


def merge_by_hand(rows, gap):
    out = []
    for c, st in sorted({(r[0], r[3]) for r in rows}):
        group = sorted((r[1], r[2]) for r in rows if (r[0], r[3]) == (c, st))
        cur, n = list(group[0]), 1
        for s, e in group[1:]:
            if s > cur[1] + gap:
                out.append((c, st, *cur, n))
                cur, n = [s, e], 0
            cur[1] = max(cur[1], e)
            n += 1
        out.append((c, st, *cur, n))
    return sorted(out)


def merged(df, gap, tile):
    return sorted(tuple(r) for r in iv.merge_intervals(df, gap=gap, tile=tile).select("contig", "strand", "start", "end", "support").collect())


@pytest.mark.parametrize("tile", [7, 64, 1000, iv.TILE])
def test_merge_equals_sweep_for_any_tile(spark, tile):
    rows = some(random.Random(1), 400) + [("long", 0, 2900, "+"), ("long", 5, 6, "+"), ("long", 2905, 2910, "+")]
    assert merged(frame(spark, rows), 5, tile) == merge_by_hand(rows, 5)


def test_merge_gap_edges(spark):
    rows = [("c", 0, 10, "+"), ("c", 19, 25, "+"), ("d", 0, 10, "+"), ("d", 20, 25, "+"), ("e", 0, 10, "+"), ("e", 21, 25, "+"), ("f", 0, 10, "+"), ("f", 0, 10, "-")]
    assert [(r[0], r[2], r[3]) for r in merged(frame(spark, rows), 10, 16)] == [
        ("c", 0, 25), ("d", 0, 25), ("e", 0, 10), ("e", 21, 25), ("f", 0, 10), ("f", 0, 10)
    ]


def test_touching_intervals_merge(spark):
    assert [r[2:] for r in merged(frame(spark, [("c", 0, 10, "+"), ("c", 10, 20, "+")]), 0, 4)] == [(0, 20, 2)]


def test_merge_is_idempotent(spark):
    once = iv.merge_intervals(frame(spark, some(random.Random(2), 200)), gap=3, tile=50)
    twice = iv.merge_intervals(once.drop("support"), gap=3, tile=77)
    assert sorted(map(tuple, once.drop("support").collect())) == sorted(map(tuple, twice.drop("support").collect()))


def test_one_hot_contig(spark):
    """A third of the rows on one place: they shrink before any window sees them."""
    hot = spark.range(30000).select(F.lit("hot").alias("contig"), F.lit(5).cast("bigint").alias("start"), F.lit(30).cast("bigint").alias("end"), F.lit("+").alias("strand"), F.lit("x").alias("name"))
    df = hot.unionByName(frame(spark, some(random.Random(4), 300)))
    out = {(r["contig"], r["start"]): r["support"] for r in iv.merge_intervals(df, gap=10, tile=100).collect()}
    assert out[("hot", 5)] == 30000
    clusters = frame(spark, [("hot", 0, 6, "+"), ("hot", 0, 5, "+"), ("hot", 29, 40, "+")])
    counts = sorted((r["start"], r["end"], r["overlaps"]) for r in iv.overlap_count(clusters, df).collect())
    assert counts == [(0, 5, 0), (0, 6, 30000), (29, 40, 30000)]


@pytest.mark.parametrize("tile, width", [(16, 8), (100, 64), (iv.TILE, 512)])
def test_overlaps_equal_the_naive_join(spark, tile, width):
    rnd = random.Random(tile)
    a, b = some(rnd, 150), some(rnd, 200) + [("c0", 0, 3000, "+"), ("c1", 100, 101, ".")]
    # Empty intervals on both sides, some of them at one place.
    a += [(c, s, s, t) for c, s, _, t in b[:40]] + [("c0", 50, 50, "+")]
    b += [(c, e, e, t) for c, _, e, t in a[:40]] + [("c0", 50, 50, "+"), ("c0", 45, 50, "+"), ("c0", 50, 55, "+")]
    x, y = frame(spark, a), frame(spark, b)
    naive = [(i, j) for i, p in enumerate(a) for j, q in enumerate(b) if p[0] == q[0] and p[3] == q[3] and p[1] < q[2] and q[1] < p[2]]
    pairs = iv.overlap_pairs(x, y, bin_width=width).select("name", "b_name").collect()
    assert sorted((int(r[0][1:]), int(r[1][1:])) for r in pairs) == sorted(naive)
    counts = {r["name"]: r["overlaps"] for r in iv.overlap_count(x, y, tile=tile).collect()}
    assert counts == {f"n{i}": sum(p == i for p, _ in naive) for i in range(len(a))}
    free = {r["name"] for r in iv.without_overlap(x, y).collect()}
    assert free == {f"n{i}" for i in range(len(a))} - {f"n{i}" for i, _ in naive}


def test_left_outer_keeps_lonely_rows(spark):
    out = iv.overlap_left_outer(frame(spark, [("c", 0, 10, "+"), ("c", 50, 60, "+")]), frame(spark, [("c", 5, 20, "-"), ("c", 10, 12, "-")])).collect()
    assert sorted((r["start"], r["b_start"], r["b_name"], r["overlap"]) for r in out) == [(0, 5, "n0", 5), (50, -1, ".", 0)]


def test_no_annotation_at_all(spark):
    a = frame(spark, [("c", 0, 10, "+")])
    empty = a.filter("false").withColumn("ftype", F.lit("CDS"))
    assert iv.intergenic(a, empty).count() == 1 and iv.antisense(a, empty).count() == 0


def test_antisense_needs_a_real_opposite_strand(spark):
    clusters = frame(spark, [("c", 0, 10, "+"), ("d", 0, 10, "-")]).withColumn("support", F.lit(1))
    cds = frame(spark, [("c", 5, 8, "-"), ("c", 6, 9, "-"), ("c", 0, 9, "."), ("d", 0, 9, "-")])
    assert [r["contig"] for r in iv.antisense(clusters, cds).collect()] == ["c"]
    assert sorted(r["b_strand"] for r in iv.antisense_pairs(clusters, cds).collect()) == ["-", "-"]


def test_cluster_pipeline_threshold_and_names(spark):
    rows = []
    for at, n in ((0, 9), (1000, 10), (2000, 11)):
        rows += [("c", at, at + 20, "+")] * n
    rows += [("b", 0, 17, "-")] * 20 + [("a", 0, 18, "-")] * 20 + [("a", 500, 750, "-")] * 20 + [("a", 5000, 5251, "-")] * 20
    df = frame(spark, rows).withColumn("sample", F.lit("S"))
    out = {r["name"]: (r["contig"], r["start"], r["support"]) for r in iv.novel_clusters(df).collect()}
    assert out == {"cluster_2": ("c", 1000, 10), "cluster_3": ("c", 2000, 11), "cluster_4": ("a", 0, 20), "cluster_5": ("a", 500, 20)}


def test_sequence_extraction_across_chunks(spark):
    rnd = random.Random(8)
    text = "".join(rnd.choice("ACGT") for _ in range(200))
    contigs = spark.createDataFrame([("c", text)], "contig string, seq string")
    regions = frame(spark, [("c", 0, 200, "+"), ("c", 15, 17, "-"), ("c", 10, 70, "+"), ("c", 190, 201, "+")])
    out = {r["fasta_id"]: r["seq"] for r in iv.extract_sequences(regions, contigs, chunk=16).collect()}
    comp = str.maketrans("ACGT", "TGCA")
    assert out == {"c:0-200(+)": text, "c:15-17(-)": text[15:17].translate(comp)[::-1], "c:10-70(+)": text[10:70]}


def test_family_hits_pass_through_without_table(spark):
    df = spark.createDataFrame([("x",), ("y",)], "fasta_id string")
    assert iv.without_family_hit(df, None).count() == 2
    assert iv.without_family_hit(df, spark.createDataFrame([("x",)], "query string")).count() == 1
