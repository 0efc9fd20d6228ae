import random

import pytest
from pyspark.sql import functions as F

from ribolake.operators import align as al
from ribolake.operators import cascade as cs
from ribolake.operators import counts as ct
from ribolake.operators import taxonomy as tx

PAIRS = str.maketrans("ACGTN", "TGCAN")


def rc(s):
    return s.translate(PAIRS)[::-1]


def brute(reads, refs, v):
    out = set()
    for s in set(reads):
        for ref, text in refs.items():
            for strand, q in (("+", s), ("-", rc(s))):
                for p in range(len(text) - len(s) + 1):
                    w = text[p:p + len(s)]
                    if set(w) <= set("ACGT"):
                        mm = sum(a != b for a, b in zip(q, w))
                        if mm <= v:
                            out.add((s, ref, p, strand, mm))
    return out


@pytest.fixture(scope="module")
def case():
    rnd = random.Random(5)
    base = lambda n: "".join(rnd.choice("ACGT") for _ in range(n))
    refs = {f"r{i}": base(n) for i, n in enumerate((40, 300, 900, 25, 16))}
    refs["n"] = base(30) + "N" + base(30)
    refs["repeat"] = "AC" * 60
    refs["palindrome"] = "ACGTACGTTTAAACGTACGTAATTACGTACG"
    refs["long"] = base(1500) + refs["r1"][:120] + base(700)
    reads = []
    for text in refs.values():
        for _ in range(25):
            n = rnd.randint(15, min(60, len(text)))
            p = rnd.randint(0, len(text) - n)
            s = list(text[p:p + n])
            for at in rnd.sample([0, n // 2, n - 1, rnd.randrange(n)], rnd.randint(0, 3)):
                s[at] = rnd.choice("ACGTN")
            s = "".join(s)
            reads.append(rc(s) if rnd.random() < 0.5 else s)
    reads += [base(20) for _ in range(20)] + ["CA" * 12, "ACAC" * 10, "A" * 15]
    return reads, refs


def frames(spark, case):
    reads, refs = case
    return spark.createDataFrame([(r,) for r in reads], "seq string"), spark.createDataFrame(list(refs.items()), "ref_id string, seq string")


def rows(df):
    out = [tuple(r) for r in df.select(*al.HIT_COLUMNS).collect()]
    assert len(out) == len(set(out))
    return set(out)


@pytest.mark.parametrize("v, k", [(0, 15), (1, 15), (1, 8), (1, 7), (2, 10), (2, 7), (2, 5), (3, 7)])
def test_all_hits_equal_brute_force(spark, case, v, k):
    reads, panel = frames(spark, case)
    index = al.build_index(panel, k=k, max_length=64)
    got = rows(al.mismatch_join(reads, index, v, "all", min_length=15))
    assert got == brute(*case, v)


def test_join_strategy_does_not_change_the_result(spark, case):
    reads, panel = frames(spark, case)
    index = al.build_index(panel, k=10, max_length=64)
    assert rows(al.mismatch_join(reads, index, 1, broadcast_rows=0)) == rows(al.mismatch_join(reads, index, 1))


@pytest.mark.parametrize("v", [2, 3])
def test_large_references_with_several_mismatches(spark, case, v):
    """Buckets of parts of the beginnings give the hits of brute force, and need no tile for a candidate."""
    reads, panel = frames(spark, case)
    long = case[1]["long"]
    longer = [long[70:140], rc(long[700:763]), long[3:65], long[3:64] + ("A" if long[64] != "A" else "C")]
    more = reads.unionByName(spark.createDataFrame([(s,) for s in longer], "seq string"))
    index = al.build_index(panel, k=7, max_length=80)
    length = 15 if v == 2 else 16
    more = more.filter(F.length("seq") >= length)
    asked = [r["seq"] for r in more.collect()]
    want = brute(asked, case[1], v)
    assert rows(al.mismatch_join(more, index, v, "all", length, 0)) == want
    least = {}
    for h in want:
        least[h[0]] = min(least.get(h[0], 9), h[4])
    assert rows(al.mismatch_join(more, index, v, "best_strata", length, 0, exact_first=True)) == {h for h in want if h[4] == least[h[0]]}
    assert index.numbered and not index.spaced
    with pytest.raises(Exception, match="not within"):
        al.mismatch_join(spark.createDataFrame([("ACGT",)], "seq string"), index, v, "best_strata", length, 0).collect()


def test_report_modes(spark, case):
    reads, panel = frames(spark, case)
    want = brute(*case, 1)
    index = al.build_index(panel, max_length=64)
    least = {}
    for h in want:
        least[h[0]] = min(least.get(h[0], 9), h[4])
    assert rows(al.mismatch_join(reads, index, 1, "best_strata")) == {h for h in want if h[4] == least[h[0]]}
    best = {}
    for s, ref, p, strand, mm in want:
        best[s] = min(best.get(s, (9,)), (mm, ref, p, strand))
    assert rows(al.mismatch_join(reads, index, 1, "best1")) == {(s, b[1], b[2], b[3], b[0]) for s, b in best.items()}
    for mode in ("best1", "best_strata"):
        one, two = (rows(al.mismatch_join(reads, index, 1, mode, exact_first=x)) for x in (False, True))
        assert one == two
    hits = al.mismatch_join(reads, index, 1)
    assert al.aligned(reads, hits).count() + al.unaligned(reads, hits).count() == reads.count()


def test_sequences_outside_the_limits_fail(spark, case):
    _, panel = frames(spark, case)
    index = al.build_index(panel, k=10, max_length=64)
    with pytest.raises(Exception, match="not within"):
        al.mismatch_join(spark.createDataFrame([("ACGT",)], "seq string"), index).collect()


def test_tiles_do_not_show(spark):
    rnd = random.Random(9)
    text = "".join(rnd.choice("ACGT") for _ in range(700))
    panel = spark.createDataFrame([("x", text)], "ref_id string, seq string")
    reads = spark.createDataFrame([(text[i:i + 30],) for i in range(0, 670)], "seq string")
    index = al.build_index(panel, k=12, max_length=40, tile=40)
    assert index.tile_rows == 18
    assert rows(al.mismatch_join(reads, index, 1)) >= {(text[i:i + 30], "x", i, "+", 0) for i in range(670)}


def test_equal_ids_in_two_panels(spark):
    """Panels keep their references apart, in any spelling of the read."""
    one, two = "ACGTTGCAACGGATCCTTAG", "TTGACCATGGCATTACGCAT"
    refs = spark.createDataFrame([("tRNA", "x", one), ("rfam", "x", two)], "panel string, ref_id string, seq string")
    index = al.build_index(refs, min_length=15)
    told = [two, two.lower(), two.replace("T", "U"), one]
    for report in ("all", "best1", "best_strata"):
        hits = al.mismatch_join(spark.createDataFrame([(s,) for s in told], "seq string"), index, 1, report, 15)
        assert {(r["seq"], r["panel"], r["ref_id"], r["mm"]) for r in hits.collect()} == {
            (s, "rfam" if s != one else "tRNA", "x", 0) for s in told
        }
    first = cs.first_match(cs.with_priority(hits, ("tRNA", "rfam"))).collect()
    assert {r["seq"]: r["priority"] for r in first} == {s: 2 if s != one else 1 for s in told}
    with pytest.raises(ValueError, match="occurs 2 times"):
        al.build_index(refs.withColumn("panel", F.lit("both")))


def test_screen_length_keeps_chance_hits_rare(spark):
    rnd = random.Random(3)
    base = lambda n: "".join(rnd.choice("ACGT") for _ in range(n))
    panel = spark.createDataFrame([(f"r{i}", base(1500)) for i in range(200)], "ref_id string, seq string")
    reads = spark.createDataFrame([(base(25),) for _ in range(400)] + [(panel.first()["seq"][40:55],)], "seq string")
    found = [r["seq"] for r in tx.rrna_screen(reads, panel).filter("is_rrna").collect()]
    assert len(found) <= 3 and panel.first()["seq"][40:55] in found


def test_cascade_partitions_the_reads(spark):
    collapsed = spark.createDataFrame([("S", s, n) for s, n in (("a", 3), ("b", 2), ("c", 1), ("d", 5))], "sample string, seq string, n bigint")
    hits = spark.createDataFrame(
        [("a", "m1", "M"), ("a", "t1", "T"), ("b", "r1", "R"), ("b", "r2", "R"), ("b", "o1", "O"), ("c", "o1", "O"), ("d", "x", "X")],
        "seq string, ref_id string, panel string",
    ).withColumns({"pos": F.lit(0), "strand": F.lit("+"), "mm": F.lit(0)})
    ranked = cs.with_priority(hits, ("M", "T", "R", "O"))
    classes = cs.host_classes(collapsed, ranked)
    assert {r["seq"]: r["rna_class"] for r in classes.collect()} == {"a": "miRNA", "b": "rRNA", "c": "otherRNA", "d": "unknown"}
    counts = {r["ref_id"]: r["reads"] for r in ct.fractional_counts(collapsed, cs.hits_of_first_class(ranked)).collect()}
    assert counts == {"m1": 3.0, "r1": 1.0, "r2": 1.0, "o1": 1.0}
    samples = spark.createDataFrame([("S",), ("empty",)], "sample string")
    summary = {(r["sample"], r["category"]): r["value"] for r in cs.host_summary(classes, samples).collect()}
    assert len(summary) == 18 and summary[("S", "trimmed")] == 11 and summary[("S", "remaining_after_miRNA")] == 8
    assert all(summary[("empty", c)] == 0 for c in cs.HOST_CATEGORIES)


def test_nonhost_order_and_gates(spark):
    one = lambda n, c: (c * n)
    s17, s18, s26, s27 = one(17, "A"), one(18, "C"), one(26, "G"), one(27, "T")
    hits = spark.createDataFrame(
        [(s17, "rfam", 0), (s18, "miRNA", 0), (s18, "rfam", 0), (s26, "miRNA", 1), (s26, "rfam", 1), (s27, "miRNA", 0)], "seq string, panel string, mm int"
    ).withColumns({"ref_id": F.col("panel"), "pos": F.lit(0).cast("bigint"), "strand": F.lit("+")})
    reads = spark.createDataFrame([(s,) for s in (s17, s18, s26, s27)], "seq string")
    rrna = reads.filter("false")
    out = {r["seq"]: r["rna_class"] for r in cs.nonhost_classes(reads, hits, rrna).collect()}
    assert out == {s17: "too_short", s18: "miRNA", s26: "rfam", s27: "unknown"}
    out = {r["seq"]: r["rna_class"] for r in cs.nonhost_classes(reads, hits, reads.limit(4)).collect()}
    assert set(out.values()) == {"rRNA"}


def test_fractional_counts_add_up_to_mapped_reads(spark, case):
    reads, panel = frames(spark, case)
    collapsed = reads.groupBy(F.lit("S").alias("sample"), "seq").agg(F.count("*").alias("n"))
    hits = al.mismatch_join(reads, al.build_index(panel, max_length=64), 1)
    total = ct.fractional_counts(collapsed, hits).agg(F.sum("reads")).first()[0]
    assert total == pytest.approx(al.aligned(reads, hits).count())


def test_lca_on_a_small_tree(spark):
    taxonomy = spark.createDataFrame(
        [(1, "root", "root", [1]), (2, "g", "g", [1, 2]), (3, "s", "s1", [1, 2, 3]), (4, "s", "s2", [1, 2, 4]), (5, "s", "s3", [1, 5])],
        "taxid int, rank string, name string, lineage array<int>",
    )
    rnd = random.Random(3)
    base = lambda n: "".join(rnd.choice("ACGT") for _ in range(n))
    shared, own3, own4, everywhere = base(30), base(30), base(30), base(30)
    panel = spark.createDataFrame(
        [("a", own3 + "N" + shared + "N" + everywhere, 3), ("b", own4 + "N" + rc(shared) + "N" + everywhere, 4), ("c", everywhere, 5)], "ref_id string, seq string, taxid int"
    )
    lca = tx.kmer_lca_table(panel, taxonomy, 15)
    reads = [own3, shared, everywhere, rc(own4), own3[:20] + "N" + own4[:20], own3 + "N" + shared, base(30), "ACGT"]
    got = {r["seq"]: r["taxid"] for r in tx.classify(spark.createDataFrame([(r,) for r in reads], "seq string"), lca, 15).collect()}
    assert [got[r] for r in reads] == [3, 2, 1, 4, 2, 3, 0, 0]
    assigned = spark.createDataFrame([("S", 3, 2), ("S", 2, 1), ("S", 0, 4)], "sample string, taxid int, n bigint")
    report = {r["taxid"]: (r["clade_reads"], r["direct_reads"]) for r in tx.clade_report(assigned, taxonomy).collect()}
    assert report == {1: (3, 0), 2: (3, 1), 3: (2, 2), 0: (4, 4)}


def test_minimizers_of_whole_length_classify_as_kmers(spark):
    rnd = random.Random(9)
    base = lambda n: "".join(rnd.choice("ACGT") for _ in range(n))
    taxonomy = spark.createDataFrame(
        [(1, "root", "root", [1]), (2, "g", "g", [1, 2]), (3, "s", "s1", [1, 2, 3]), (4, "s", "s2", [1, 2, 4]), (5, "s", "s3", [1, 5])],
        "taxid int, rank string, name string, lineage array<int>",
    )
    shared, own3, own4 = base(1500), base(1200), base(700)
    refs = [("a", own3 + "N" + shared + "A" * 300, 3), ("b", rc(shared) + "nn" + own4, 4), ("c", base(90) + own3[500:620].lower().replace("t", "u"), 5), ("d", base(60), None), ("e", base(60), 99), ("f", "", 3), ("g", None, 3)]
    panel = spark.createDataFrame(refs, "ref_id string, seq string, taxid int")
    reads = [own3[i : i + 40] for i in range(0, 1160, 37)] + [rc(shared[i : i + 60]) for i in range(0, 1440, 91)] + [own4, shared + own4, own3[:30] + "N" + own3[30:70], base(50), "A" * 50, "ACGT", "", refs[3][1]]
    asked = spark.createDataFrame([(r,) for r in [*reads, None]], "seq string")
    rows = lambda df: sorted(map(str, df.collect()))
    exact = rows(tx.classify(asked.filter("seq is not null"), tx.kmer_lca_table(panel, taxonomy, 21), 21))
    assert rows(tx.classify_by_minimizers(asked.filter("seq is not null"), tx.minimizer_lca_table(panel, taxonomy, 21, 21), 21, 21)) == exact
    # Unrelated stretches share no 15-mers here, so shorter minimizers find the same taxa in a much smaller table;
    # a k-mer over a seam is unknown itself but may have a known minimizer, so scores may only grow.
    table = tx.minimizer_lca_table(panel, taxonomy, 25, 15)
    every = tx.kmer_lca_table(panel, taxonomy, 25)
    named = lambda df: {r["seq"]: (r["taxid"], r["score"]) for r in df.collect()}
    want, got = named(tx.classify(asked.filter("seq is not null"), every, 25)), named(tx.classify_by_minimizers(asked, table, 25, 15))
    assert {s: t for s, (t, _) in got.items() if s is not None} == {s: t for s, (t, _) in want.items()}
    assert got[None] == (0, 0) and all(got[s][1] >= n for s, (_, n) in want.items())
    assert table.count() * 4 < every.count()
    assert tx.minimizer_lca_table(panel.limit(0), taxonomy).count() == 0


def test_minimizers_against_a_plain_loop(spark):
    rnd = random.Random(2)
    text = "".join(rnd.choice("ACGT") for _ in range(700))
    k, m, mask = 35, 31, tx.MINIMIZER_MASK % 4**31
    number = lambda w: int(min(w, rc(w)).translate(str.maketrans("ACGT", "0123")), 4)
    want = {}
    for i in range(len(text) - k + 1):
        least = min(number(text[i + j : i + j + m]) ^ mask for j in range(k - m + 1)) ^ mask
        want[least] = want.get(least, 0) + 1
    rows = tx.minimizers(spark.createDataFrame([(text,)], "_piece string"), k, m).collect()
    assert {r["minimizer"]: r["n"] for r in rows} == want and len(rows) == len(want)
    with pytest.raises(ValueError):
        tx.minimizers(spark.createDataFrame([(text,)], "_piece string"), 35, 32)


def test_rrna_screen(spark):
    panel = spark.createDataFrame([("r", "ACGTTGCAACGGATCCTTAGCA")], "ref_id string, seq string")
    reads = spark.createDataFrame([("ACGTTGCAACGGATC",), (rc("ACGTTGCAACGGATC"),), ("T" * 20,), ("ACGT",)], "seq string")
    out = [r["seq"] for r in tx.rrna_screen(reads, panel, 12).filter("is_rrna").collect()]
    assert sorted(out) == sorted(["ACGTTGCAACGGATC", rc("ACGTTGCAACGGATC")])


def test_assembly_branch(spark):
    """One read on two places, half on each; the feature with most overlap wins."""
    from ribolake.plans.assembly import assembly_based

    rnd = random.Random(6)
    unit, filler = ("".join(rnd.choice("ACGT") for _ in range(n)) for n in (20, 50))
    contigs = spark.createDataFrame([("k", unit + filler + unit)], "ref_id string, seq string")
    annotation = spark.createDataFrame(
        [("k", 0, 25, "CDS", "+", "f1"), ("k", 15, 40, "gene", "+", "f2"), ("k", 85, 95, "gene", "-", "f3")],
        "contig string, start bigint, end bigint, ftype string, strand string, name string",
    )
    collapsed = spark.createDataFrame([("S", unit, 6), ("S", filler, 2)], "sample string, seq string, n bigint")
    out = assembly_based(collapsed, contigs, annotation, v=1, max_length=40)
    counts = {r["feature"]: (r["raw"], r["weighted"]) for r in out["counts"].collect()}
    assert counts == {"f1": (6, 3.0), "f3": (6, 3.0), "f2": (2, 2.0)}
    assert [(r["length"], r["reads"]) for r in out["lengths"].collect()] == [(20, 6.0)]


def test_preprocess_and_classification_plans(spark):
    from ribolake.plans.classification import host_specific, nonhost_specific
    from ribolake.plans.preprocessing import preprocess

    rnd = random.Random(12)
    base = lambda n: "".join(rnd.choice("ACGT") for _ in range(n))
    host, trna, rrna, other = base(200), base(80), base(80), base(60)
    adapter = "TGGAATTCTCGG"
    inserts = [host[10:40], host[50:75], trna[5:35], rrna[10:40], other[:30], other[:30], "ACG"]
    raw = spark.createDataFrame(
        [(s, f"{s}{i}", x + adapter, "I" * (len(x) + 12)) for s in ("A", "B") for i, x in enumerate(inserts)],
        "sample string, read_id string, seq string, qual string",
    )
    refs = spark.createDataFrame([("h", "genome", host)], "ref_id string, panel string, seq string")
    pre = preprocess(raw, refs, ("genome",))
    got = {(r["sample"], r["category"]): r["value"] for r in pre["summary"].collect()}
    assert got == {(s, c): n for s in "AB" for c, n in (("input", 7), ("trimmed", 6), ("host", 2), ("non_host", 4))}
    samples = raw.select("sample").distinct()
    panels = spark.createDataFrame([("m", "M", host[:45]), ("t", "T", "A" * 30), ("r", "R", "C" * 30), ("o", "O", "G" * 30)], "ref_id string, panel string, seq string")
    out = host_specific(pre["host"], panels, ("M", "T", "R", "O"), samples)["summary"].filter("sample = 'A'").collect()
    assert {r["category"]: r["value"] for r in out}["human_miRNA"] == 1 and {r["category"]: r["value"] for r in out}["unknown_after_all"] == 1
    panels = spark.createDataFrame([("t", "tRNA", trna)], "ref_id string, panel string, seq string")
    taxonomy = spark.createDataFrame([(1, "root", "root", [1]), (7, "s", "x", [1, 7])], "taxid int, rank string, name string, lineage array<int>")
    non = nonhost_specific(pre["non_host"], panels, spark.createDataFrame([("r", rrna, 7)], "ref_id string, seq string, taxid int"), samples, taxonomy)
    got = {r["category"]: (r["value"], r["unit"]) for r in non["summary"].filter("sample = 'B'").collect()}
    assert got["rrna_reads"] == (1, "reads") and got["trna_like_reads"] == (1, "reads") and got["unknown_sequences"] == (1, "sequences")
    assert [(r["seq"], r["n"]) for r in non["unknown"].filter("sample = 'A'").collect()] == [(other[:30], 2)]
    assert {r["taxid"]: r["clade_reads"] for r in non["clades"].filter("sample = 'A'").collect()} == {1: 1, 7: 1}


def test_preprocessing_writes_reads_once(spark):
    """Of the split only the matching sequences are written."""
    from pathlib import Path

    from ribolake.operators.staging import staging_folder
    from ribolake.plans.preprocessing import preprocess

    rnd = random.Random(8)
    host = "".join(rnd.choice("ACGT") for _ in range(90))
    inserts = [host[5:40], host[20:60], "ACGTTGCA" * 4, "GATTACAT" * 3]
    raw = spark.createDataFrame([("A", f"r{i}", x, "I" * len(x)) for i, x in enumerate(inserts)], "sample string, read_id string, seq string, qual string")
    refs = spark.createDataFrame([("h", "genome", host)], "ref_id string, panel string, seq string")
    folder = Path(staging_folder(spark))
    old = set(folder.iterdir()) if folder.exists() else set()
    out = preprocess(raw, refs, ("genome",), adapter="")
    assert sorted(r["read_id"] for r in out["host"].collect()) == ["r0", "r1"]
    assert sorted(r["qual"] for r in out["non_host"].collect()) == ["I" * 24, "I" * 32]
    written = [spark.read.parquet(str(p)) for p in set(folder.iterdir()) - old]
    assert sum("read_id" in t.columns for t in written) == 1
