"""Look-up of k-mers inside Arrow tasks and inputs written once, against plain loops and the joins beside them."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from ribolake.operators import align as al
from ribolake.operators import kmers as km
from ribolake.operators import quality as qc
from ribolake.operators import reads as rd
from ribolake.operators import taxonomy as tx
from ribolake.registry import inputs

from test_align import rc


def _text(rnd, n, letters="ACGT"):
    return "".join(rnd.choice(letters) for _ in range(n))


def test_codes_of_a_batch_against_a_plain_loop():
    rnd = random.Random(5)
    texts = [_text(rnd, rnd.randint(0, 60), "ACGTacgtUuN") for _ in range(200)] + ["", None, "é" + _text(rnd, 40), "ACGT"]
    number = lambda w: int(min(w, rc(w)).translate(str.maketrans("ACGT", "0123")), 4)
    for k in (1, 2, 3, 7, 12, 16, 21, 31):
        want = []
        for i, text in enumerate(texts):
            clean = (text or "").upper().replace("U", "T")
            words = [clean[p:p + k] for p in range(len(clean) - k + 1)]
            want += [(i, number(w)) for w in words if set(w) <= set("ACGT")]
        for column in (pa.array(texts), pa.array(["ACGTACGTACGTACGT", *texts]).slice(1)):
            codes, row = km.batch_codes(column, k)
            assert list(zip(row.tolist(), codes.tolist())) == want


def test_searched_where_the_reads_are_as_joined(spark, monkeypatch):
    rnd = random.Random(6)
    lineages = [[1], [1, 2], [1, 2, 3], [1, 2, 4], [1, 5], [1, 5, 6], [7]]
    taxonomy = spark.createDataFrame([(x[-1], x) for x in lineages], "taxid int, lineage array<int>")
    # References are put together from a few pieces, so that they share k-mers and reads have ties.
    parts = [_text(rnd, 17) for _ in range(30)] + ["N"]
    refs = [(f"r{i}", "".join(rnd.choice(parts) for _ in range(18)), lineages[i % 7][-1]) for i in range(12)]
    panel = spark.createDataFrame(refs, "ref_id string, seq string, taxid int")
    reads = [rnd.choice(refs)[1][p:p + rnd.randint(5, 60)] for p in (rnd.randint(0, 250) for _ in range(300))] + ["", "ACGT", "A" * 30, None]
    asked = spark.createDataFrame([(s if s is None or i % 3 else rc(s).lower(),) for i, s in enumerate(reads)] * 2, "seq string")
    lca = tx.kmer_lca_table(panel, taxonomy, 11)
    rows = lambda df: sorted(map(str, df.collect()))
    run = lambda: (tx.classify(asked, lca, 11), tx.rrna_screen(asked, panel, 11), tx.assign(asked.withColumn("n", F.lit(2)), lca, 11))
    near = run()
    # No read is unfolded or joined.
    plan = near[0]._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan and "Join" not in plan
    got = [rows(df) for df in near]
    monkeypatch.setattr(tx, "fits", lambda *_: False)
    assert got == [rows(df) for df in run()]
    assert len({r["taxid"] for r in near[0].collect()}) > 4 and len(got[2]) == len(reads) * 2


def test_reads_are_cut_from_texts_once(spark):
    sf = "/root/testdata/sf0.001"
    inputs._WRITTEN.clear()
    for name in ("reads", "clean", "uniq", "coll"):
        inputs.spark_table(spark, sf, name)
    # One written table stands behind all of them.
    assert {n for _, _, n in inputs._WRITTEN} == {"reads", "clean", "uniq", "coll", "inserts", "pn", "ct"}
    plan = inputs._derived(spark, sf, "uniq")._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan and "Generate" not in plan


def test_adapters_are_counted_in_buckets_as_by_a_plain_loop(spark):
    rnd = random.Random(7)
    adapter, k, first = "TGGAATTCTCGGGTGCC", 12, 15
    reads = []
    for i in range(1500):
        sample = rnd.choice(["a", "a", "b", "c", f"few{i % 150}"])
        own = _text(rnd, rnd.randint(0, 40), "ACGTN") + (adapter * rnd.randint(1, 2) if sample in "ab" and rnd.random() < 0.3 else "")
        reads.append((sample, own))
    reads += [("a", "é" + _text(rnd, 20) + adapter), ("d", None), ("d", ""), (None, _text(rnd, 40))] + [("e", "CC" * 30)] * 9
    rows = sorted({r for r in reads if None not in r})
    want, counts = {}, {}
    for sample, text in rows:
        for kmer in {text[p:p + k] for p in range(first, len(text) - k + 1)}:
            counts[sample, kmer] = counts.get((sample, kmer), 0) + 1
    total = {s: sum(1 for x, _ in rows if x == s) for s, _ in rows}
    for (sample, kmer), n in sorted(counts.items(), key=lambda e: (-e[1], e[0][1])):
        want.setdefault(sample, (kmer, n))
    want = {s: e for s, e in want.items() if e[1] >= 5 and e[1] >= 0.1 * total[s]}
    df = spark.createDataFrame(reads, "sample string, seq string")
    got = {r["sample"]: (r["adapter"], r["reads"]) for r in rd.detect_adapters(df).collect()}
    assert set(got) == set(want) >= {"a", "b"}
    assert all(got[s][0].endswith(kmer) and got[s][1] == n for s, (kmer, n) in want.items())
    # Only k-mers of frequent buckets are counted one by one; with all buckets all of them are.
    known = spark.createDataFrame(rows, "sample string, seq string")
    every = km.kmer_counts(known.withColumn("buckets", F.sequence(F.lit(0), F.lit(km.BUCKETS - 1))), k, first)
    assert {(r["sample"], r["kmer"]): r["reads"] for r in every.collect()} == counts
    places = sum(max(0, len(text) - k - first + 1) for _, text in rows)
    assert km.bucket_counts(known, k, first).agg(F.sum("n")).first()[0] == places


def test_positions_are_counted_inside_tasks(spark):
    rnd = random.Random(8)
    reads = [(rnd.choice("AB"), _text(rnd, n, "ACGTNa"), _text(rnd, n, "I?5#!")) for n in (rnd.randint(0, 30) for _ in range(300))]
    reads += [("B", "ACé", "Ié5"), ("A", "ACGT", "I"), ("A", "ACG", None), ("A", None, "II"), (None, "AC", "II"), ("A", "AC", "IIII")]
    want = {}
    for sample, seq, qual in reads:
        for p, base in enumerate(seq or ""):
            phred = None if qual is None else ord(qual[p]) - 33 if p < len(qual) else -33
            key = (sample, p + 1, base if base in qc.BASES else "", phred)
            want[key] = want.get(key, 0) + 1
    for extra in ([], [("B", "A" * 40_000, "I" * 40_000)]):
        df = spark.createDataFrame(reads + extra, "sample string, seq string, qual string")
        rows = qc.position_counts(df).groupBy("sample", "position", "base", "phred").agg(F.sum("n").alias("n"))
        got = {tuple(r)[:4]: r["n"] for r in rows.filter("position <= 30").collect()}
        for p in range(30 if extra else 0):
            want["B", p + 1, "A", 40] = want.get(("B", p + 1, "A", 40), 0) + 1
        assert got == want
    # An empty read has no position.
    empty = spark.createDataFrame([("A", "", "")], "sample string, seq string, qual string")
    assert qc.position_profile(empty).count() == 0 and qc.quality_quantiles(empty).count() == 0


def test_minimizers_are_searched_where_the_reads_are(spark, monkeypatch):
    rnd = random.Random(10)
    taxonomy = spark.createDataFrame([(x[-1], x) for x in ([1], [1, 2], [1, 2, 3], [1, 4])], "taxid int, lineage array<int>")
    parts = [_text(rnd, 40) for _ in range(12)] + ["N"]
    refs = [(f"r{i}", "".join(rnd.choice(parts) for _ in range(12)), (1, 2, 3, 4)[i % 4]) for i in range(8)]
    panel = spark.createDataFrame(refs, "ref_id string, seq string, taxid int")
    texts = [rnd.choice(refs)[1][p:p + rnd.randint(5, 90)] for p in (rnd.randint(0, 380) for _ in range(200))] + ["", "ACGT", "A" * 50, None]
    asked = spark.createDataFrame([(s if s is None or i % 3 else rc(s).lower(),) for i, s in enumerate(texts)], "seq string")
    table = tx.minimizer_lca_table(panel, taxonomy, 25, 19)
    run = lambda: tx.classify_by_minimizers(asked, table, 25, 19)
    near = run()
    assert "MapInArrow" in near._jdf.queryExecution().executedPlan().toString()
    got = sorted(map(str, near.collect()))
    monkeypatch.setattr(tx, "fits", lambda *_: False)
    assert got == sorted(map(str, run().collect())) and len({r["taxid"] for r in near.collect()}) > 3


def test_exact_search_sieves_reads_too(spark):
    rnd = random.Random(11)
    ref = _text(rnd, 400)
    own = [ref[100:120], rc(ref[200:226]).lower(), ref[300:318].replace("T", "U")]
    reads = spark.createDataFrame([(s,) for s in own + [_text(rnd, rnd.randint(18, 26)) for _ in range(2000)]], "seq string")
    index = al.build_index(spark.createDataFrame([("r", ref)], "ref_id string, seq string"), min_length=18)
    kept = {r["seq"] for r in al.sieved(reads, index, 18, v=0).collect()}
    assert set(own) <= kept and len(kept) < 20
    hits = al.mismatch_join(reads, index, 0, "best1", 18)
    assert set(index.sieves) == {(15, 0)} and {(r["seq"], r["pos"], r["strand"], r["mm"]) for r in hits.collect()} == {
        (own[0], 100, "+", 0), (own[1], 200, "-", 0), (own[2], 300, "+", 0)
    }
