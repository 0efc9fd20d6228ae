"""Searches whose rows travel in blocks, against brute force, and what they write into shuffles."""

import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ribolake.operators import align as al
from ribolake.operators import blocks
from ribolake.operators import counts as ct

from test_align import brute, rc


def text(rnd, n):
    return "".join(rnd.choice("ACGT") for _ in range(n))


@pytest.fixture(scope="module")
def odd():
    """References with tile borders, palindromes and unknown bases; reads of 15 to 70 bases, some not distinct, in RNA or in lower case."""
    rnd = random.Random(11)
    half = text(rnd, 8)
    palindrome = half + rc(half)
    refs = {"a": text(rnd, 1300), "b": text(rnd, 40) + palindrome + text(rnd, 60), "n": text(rnd, 50) + "N" + text(rnd, 70), "s": text(rnd, 16)}
    refs["copy"] = text(rnd, 30) + refs["a"][500:640] + refs["b"][20:90]
    refs["repeat"] = "AC" * 50
    reads = [palindrome, refs["b"][30:75], "AC" * 20, "CA" * 8, "A" * 40, "N" * 20]
    for _ in range(500):
        source = refs[rnd.choice(list(refs))]
        n = min(len(source), rnd.choice([15, 16, 20, 31, 32, 33, 47, 61, 62, 63, 70]))
        p = rnd.choice([0, len(source) - n, rnd.randint(0, len(source) - n)])
        s = list(source[p:p + n])
        for at in rnd.sample(range(n), rnd.choice([0, 0, 1, 1, 2])):
            s[at] = rnd.choice("ACGTN")
        reads.append(rc("".join(s)) if rnd.random() < 0.5 else "".join(s))
    given = reads + reads[:50] + [s.lower() for s in reads[50:80]] + [s.replace("T", "U") for s in reads[80:120]]
    return given, refs


def found(spark, odd, **options):
    given, refs = odd
    index = al.build_index(spark.createDataFrame(list(refs.items()), "ref_id string, seq string"), strands=options.pop("strands", "both"))
    reads = spark.createDataFrame([(s,) for s in given], "seq string").repartition(3)
    out = [tuple(r) for r in al.mismatch_join(reads, index, options.pop("v", 1), min_length=15, broadcast_rows=0, counted=True, **options).select(*al.HIT_COLUMNS, "n_hits").collect()]
    assert len(out) == len(set(out))
    return set(out)


def wanted(odd, keep=lambda hit, least: True, v=1):
    given, refs = odd
    clean = {s: s.upper().replace("U", "T") for s in set(given)}
    by_text = {}
    for hit in brute(clean.values(), refs, v):
        by_text.setdefault(hit[0], []).append(hit)
    out = set()
    for s, t in clean.items():
        hits = [h for h in by_text.get(t, []) if keep(h, min(x[4] for x in by_text[t]))]
        out |= {(s, *h[1:], len(hits)) for h in hits}
    return out


def test_all_hits_with_their_number(spark, odd):
    assert found(spark, odd) == wanted(odd)


def test_one_strand(spark, odd):
    assert found(spark, odd, strands="plus") == wanted(odd, lambda h, least: h[3] == "+")


def test_best_hits_with_their_number(spark, odd):
    want = wanted(odd, lambda h, least: h[4] == least)
    assert found(spark, odd, report="best_strata") == want
    first = {}
    for s, ref, pos, strand, mm, _ in want:
        first[s] = min(first.get(s, (9,)), (mm, ref, pos, strand))
    assert found(spark, odd, report="best1") == {(s, *h[1:], h[0], 1) for s, h in first.items()}


def test_several_mismatches(spark, odd):
    assert found(spark, odd, v=2) == wanted(odd, v=2)
    assert found(spark, odd, v=2, report="best_strata", strands="plus") == {
        (*h[:5], n) for h, n in _best_of_strand(wanted(odd, lambda h, least: h[3] == "+", 2))
    }


def _best_of_strand(hits):
    least, kept = {}, {}
    for h in hits:
        least[h[0]] = min(least.get(h[0], 9), h[4])
    for h in hits:
        if h[4] == least[h[0]]:
            kept.setdefault(h[0], []).append(h)
    return [(h, len(group)) for group in kept.values() for h in group]


def test_counted_hits_need_no_second_count(spark, odd):
    hits = spark.createDataFrame([("a", 0, 1)], "seq string, mm int, n_hits bigint")
    assert ct.multihit_count(hits).collect() == hits.collect()
    assert ct.hit_weights(hits, 0).select("n_hits", "weight").first() == (1, 1.0)


def test_blocks_keep_numbers():
    rnd = np.random.default_rng(3)
    columns = [rnd.integers(0, 1 << 62, 900), rnd.integers(0, 300, 900), np.zeros(900, np.int64)]
    both = blocks.unpack(pa.array([blocks.pack(columns), blocks.pack([c[:1] for c in columns])]), 3)
    assert all((np.r_[c, c[:1]] == got).all() for c, got in zip(columns, both))


def test_a_search_on_large_references_writes_little(spark):
    """Shuffle files of single rows with texts took 100 bytes a window; blocks of numbers take less than 30."""
    rnd = random.Random(12)
    refs = [(f"contig_{i}", text(rnd, 600)) for i in range(200)]
    reads = [(rnd.choice(refs)[1][p:p + rnd.randint(15, 50)],) for p in (rnd.randint(0, 540) for _ in range(5000))]
    index = al.build_index(spark.createDataFrame(refs, "ref_id string, seq string"))
    assert index.seed_rows > al.LARGE_ROWS
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    written = lambda: {f: f.stat().st_size for folder in folders for f in Path(folder).rglob("shuffle_*.data")}
    before = written()
    assert al.mismatch_join(spark.createDataFrame(reads, "seq string"), index, 1, min_length=15).agg(F.count_distinct("seq")).first()[0] == len(set(reads))
    assert sum(size for file, size in written().items() if file not in before) < 30 * index.seed_rows
