from pyspark.sql import functions as F
import pytest

from ribolake.functions import sequence as sq
from ribolake.operators import quality as qc
from ribolake.operators import reads as rd
from ribolake.operators import samples as sm
from ribolake.operators.ranking import ranked

ADAPTER = "TGGAATTCTCGGGTGCCAAGG"


def reads(spark, *seqs):
    return spark.createDataFrame([("S", s, "I" * len(s)) for s in seqs], "sample string, seq string, qual string")


def seqs(df):
    return sorted(r["seq"] for r in df.collect())


def test_length_limits_include_both_ends(spark):
    df = reads(spark, "A" * 14, "A" * 15, "A" * 250, "A" * 251)
    assert [len(s) for s in seqs(rd.length_filter(df))] == [15, 250]


def test_length_classes(spark):
    out = rd.length_class(reads(spark, *["A" * n for n in (17, 18, 26, 27)])).collect()
    assert {len(r["seq"]): r["length_class"] for r in out} == {17: "too_short", 18: "short", 26: "short", 27: "long"}


@pytest.mark.parametrize("read, kept", [
    ("ACGTACGTACGTAAA" + ADAPTER + "CCCC", "ACGTACGTACGTAAA"),
    ("ACGTACGTACGTAAA" + ADAPTER[:4], "ACGTACGTACGTAAA"),
    ("ACGTACGTACGTAAA" + ADAPTER[:3], "ACGTACGTACGTAAA" + ADAPTER[:3]),
    ("ACGTACGTACGTAAA" + ADAPTER[:20], "ACGTACGTACGTAAA"),
    (ADAPTER, ""),
    (ADAPTER + "AA" + ADAPTER, ""),
])
def test_adapter(spark, read, kept):
    row = rd.trim_adapter(reads(spark, read), ADAPTER).first()
    assert row["seq"] == kept and len(row["qual"]) == len(kept)


def test_quality_filter_limits(spark):
    rows = [("S", "ACGTACGTAC", "!" * 4 + "I" * 6), ("S", "CCGTACGTAC", "!" * 5 + "I" * 5), ("S", "NNNNNACGTA", "I" * 10), ("S", "NNNNNNCGTA", "I" * 10)]
    df = spark.createDataFrame(rows, "sample string, seq string, qual string")
    assert seqs(rd.quality_filter(df)) == ["ACGTACGTAC", "NNNNNACGTA"]


def test_phred_14_is_low_and_15_is_not(spark):
    df = spark.createDataFrame([(chr(33 + 14),), (chr(33 + 15),)], "q string")
    assert [r[0] for r in df.select(sq.low_quality_bases(F.col("q"))).collect()] == [1, 0]


def test_reverse_complement_twice_is_identity(spark):
    df = spark.createDataFrame([("ACGTNRYKMBDHVSW",), ("AACCGGTT",)], "s string")
    out = df.select("s", sq.revcomp(sq.revcomp(F.col("s"))).alias("t"), sq.revcomp(F.col("s")).alias("r")).collect()
    assert all(r["s"] == r["t"] for r in out) and out[1]["r"] == "AACCGGTT"


def test_hamming_is_not_edit_distance_above_one(spark):
    df = spark.createDataFrame([("ABABABAB", "BABABABA"), ("ABAB", "ABAA"), ("AB", "BA")], "a string, b string")
    a, b = F.col("a"), F.col("b")
    out = df.select(sq.hamming(a, b), sq.mismatches_up_to(a, b, 2), sq.mismatches_up_to(a, b, 1)).collect()
    assert [tuple(r) for r in out] == [(8, None, None), (1, 1, 1), (2, 2, None)]


def test_collapse_and_rank(spark):
    df = reads(spark, "CC", "CC", "AA", "GG", "GG")
    out = {r["seq"]: (r["rank"], r["collapsed_id"]) for r in rd.collapse_ranked(df).collect()}
    assert out == {"CC": (1, "1-2"), "GG": (2, "2-2"), "AA": (3, "3-1")}


def test_ranked_restarts_per_group_and_has_no_gaps(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("g"), (F.col("id") * 7919 % 1000).alias("x"))
    out = ranked(df, ["x"], by="g").collect()
    for g in "ab":
        rows = sorted((r["rank"], r["x"]) for r in out if r["g"] == g)
        assert [r for r, _ in rows] == list(range(1, len(rows) + 1))
        assert [x for _, x in rows] == sorted(x for _, x in rows)


def test_adapter_detection_per_sample(spark):
    import random

    rnd = random.Random(2)
    base = lambda n: "".join(rnd.choice("ACGT") for _ in range(n))
    adapter = "TGGAATTCTCGGGTGCCAAGG"
    rows = [("with", base(rnd.randint(15, 26)) + adapter[: rnd.randint(12, 21)]) for _ in range(100)]
    rows += [("cycles", (base(rnd.randint(18, 26)) + adapter + base(20))[:50]) for _ in range(100)]
    abundant = base(22)
    rows += [("none", base(22)) for _ in range(70)] + [("none", abundant)] * 30
    df = spark.createDataFrame([(s, x, "I" * len(x)) for s, x in rows], "sample string, seq string, qual string")
    found = {r["sample"]: r["adapter"] for r in rd.detect_adapters(df).collect()}
    assert set(found) == {"with", "cycles"}
    assert all(adapter.startswith(a) and len(a) >= 12 for a in found.values())
    out = rd.trim_detected(df, rd.detect_adapters(df)).collect()
    assert sorted(r["seq"] for r in out if r["sample"] == "none") == sorted(x for s, x in rows if s == "none")
    assert all(len(r["seq"]) <= 26 and len(r["seq"]) == len(r["qual"]) for r in out)


def test_profiles(spark):
    df = spark.createDataFrame([("S", "AC", "I!"), ("S", "G", "5")], "sample string, seq string, qual string")
    out = {r["position"]: r for r in qc.position_profile(df).collect()}
    assert out[1]["reads"] == 2 and out[1]["mean_quality"] == 30 and out[1]["a_bases"] == 1
    assert out[2]["reads"] == 1 and out[2]["mean_quality"] == 0
    assert {(r["gc_percent"], r["reads"]) for r in qc.gc_histogram(df).collect()} == {(50, 1), (100, 1)}


def test_quartiles_against_exact(spark):
    import numpy as np

    df = spark.createDataFrame([("S", "A", chr(33 + q)) for q in range(41)], "sample string, seq string, qual string")
    row = qc.quality_quantiles(df).first()
    assert [row["lower"], row["median"], row["upper"]] == list(np.percentile(range(41), [25, 50, 75], method="inverted_cdf"))


def test_sample_rules(spark):
    df = spark.createDataFrame([("a", " ", "x"), ("a", "t", "y"), ("b", "", "z")], "name string, type string, fastq string")
    assert {r["type"] for r in sm.with_defaults(df).collect()} == {"sRNA-Ext", "t"}
    with pytest.raises(ValueError, match="duplicate"):
        sm.check_samples(df)
    wanted = spark.createDataFrame([("b",), ("c",)], "name string")
    with pytest.raises(ValueError, match="not found: c"):
        sm.check_samples(df.filter("type <> 't'"), wanted)
    assert [r["name"] for r in sm.select_samples(df, wanted).collect()] == ["b"]
