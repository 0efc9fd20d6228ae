"""Steps that keep the work near the size of the input, against brute force."""

import random

from pyspark.sql import functions as F

from ribolake.functions import sequence as sq
from ribolake.operators import align as al

from test_align import brute, case, frames, rc, rows  # noqa: F401


def test_sieve_leaves_few_reads_and_loses_no_hit(spark, case):  # noqa: F811
    _, refs = case
    rnd = random.Random(8)
    noise = ["".join(rnd.choice("ACGT") for _ in range(rnd.randint(15, 50))) for _ in range(3000)]
    own = [refs["r2"][100:130], refs["r2"][200:215].lower(), rc(refs["r2"][300:340]), refs["r2"][50:70].replace("T", "U"), "N" + refs["r1"][21:50]]
    reads = spark.createDataFrame([(s,) for s in noise + own], "seq string")
    small = {k: refs[k] for k in ("r0", "r1", "r2")}
    index = al.build_index(spark.createDataFrame(list(small.items()), "ref_id string, seq string"))
    kept = {r[0] for r in al.sieved(reads, index, 15).collect()}
    assert set(own) <= kept and len(kept) < 100
    clean = {s: s.upper().replace("U", "T") for s in noise + own}
    want = {(s, *h[1:]) for s, text in clean.items() if s in own or s in kept for h in brute([text], small, 1)}
    want |= {h for h in brute([s for s in noise if s not in kept], small, 1)}
    assert rows(al.mismatch_join(reads, index, 1)) == want
    assert rows(al.mismatch_join(reads, index, 1, broadcast_rows=0)) == want


def test_large_references_meet_short_reads_in_buckets(spark, case):  # noqa: F811
    reads, refs = case
    rnd = random.Random(9)
    for _ in range(200):
        text = refs[rnd.choice(["r2", "long", "n", "repeat", "palindrome"])]
        n = rnd.randint(15, 33)
        p = rnd.randint(0, max(0, len(text) - n))
        s = list(text[p:p + n])
        s[rnd.choice([0, 6, 7, 13, 14, len(s) - 1])] = rnd.choice("ACGTN")
        reads = [*reads, rc("".join(s)) if rnd.random() < 0.5 else "".join(s)]
    r, p = frames(spark, (reads, refs))
    index = al.build_index(p)
    assert rows(al.mismatch_join(r, index, 1, min_length=15, broadcast_rows=0)) == brute(reads, refs, 1)
    assert set(index.windows) == {14} and set(index.longer) == {16}
    plus = al.build_index(p, strands="plus")
    assert rows(al.mismatch_join(r, plus, 1, min_length=15, broadcast_rows=0)) == {h for h in brute(reads, refs, 1) if h[3] == "+"}


def test_reads_without_a_piece_of_the_adapter_are_not_compared(spark):
    adapter, share, least = "TGGAATTCTCGGGTGCCAAGG", 0.1, 4
    anywhere = sq._adapter_screen(adapter, share, least)
    rnd = random.Random(4)
    text = lambda n: "".join(rnd.choice("ACGT") for _ in range(n))
    reads = ["", "ACG", "N" * 30]
    for _ in range(600):
        tail = list(adapter[:rnd.randint(0, 21)] + text(rnd.choice([0, 0, 3])))
        for at in rnd.sample(range(len(tail)), min(len(tail), rnd.randint(0, 3))):
            tail[at] = rnd.choice("ACGTN")
        reads.append(text(rnd.randint(0, 40)) + "".join(tail))

    def kept(s, limit_of):
        for at in range(len(s) - least + 1):
            n = min(len(s) - at, len(adapter))
            if sum(a != b for a, b in zip(s[at:at + n], adapter)) <= limit_of(n):
                return at
        return len(s)

    for rate in (share, 0.0, 0.25, 0.9):
        got = spark.createDataFrame([(s,) for s in reads], "seq string").select("seq", sq.kept_length_with_errors(F.col("seq"), adapter, rate, least))
        assert all(at == kept(s, lambda n: int(n * rate + 1e-9)) for s, at in got.collect())
    plain = spark.createDataFrame([(text(35),) for _ in range(1000)], "seq string")
    assert plain.filter(F.col("seq").rlike(anywhere)).count() < 250
