"""Two mismatches, edits, kept indexes, hit weights, ids and misread adapters against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from ribolake.functions.reference_ids import trna_dimensions
from ribolake.operators import align, counts, edits, reads as rd, seedstore

BASES = "ACGT"


def mirrored(seq):
    return seq[::-1].translate(str.maketrans(BASES, "TGCA"))


def changed(rng, seq, subs=0, dels=0, ins=0):
    seq = list(seq)
    for _ in range(subs):
        seq[rng.randrange(len(seq))] = rng.choice(BASES)
    for _ in range(dels):
        del seq[rng.randrange(len(seq))]
    for _ in range(ins):
        seq.insert(rng.randrange(len(seq)), rng.choice(BASES))
    return "".join(seq)


@pytest.fixture(scope="module")
def panel():
    rng = random.Random(4)
    refs = {f"r{i}": "".join(rng.choice(BASES) for _ in range(rng.randint(20, 900))) for i in range(5)}
    refs["n"] = refs["r0"][:60] + "N" + refs["r0"][60:120]
    refs["repeat"] = "ACACACACACACACACACACACACACACACACACAC"
    return refs


@pytest.fixture(scope="module")
def sequences(panel):
    rng = random.Random(9)
    out = {"ACACACACACACACACAC", "GTGTGTGTGTGTGTG", "ACGTACGTACGTACGNACGT"}
    for _ in range(160):
        text = rng.choice(list(panel.values()))
        size = rng.randint(15, 60)
        at = rng.randrange(max(1, len(text) - size))
        piece = text[at : at + size].replace("N", "A")
        piece = changed(rng, piece, rng.randint(0, 3), rng.randint(0, 1), rng.randint(0, 1)) if len(piece) > 17 else piece
        if len(piece) >= 15:
            out.add(mirrored(piece) if rng.random() < 0.5 else piece)
    return sorted(out)


def frames(spark, panel, sequences):
    return spark.createDataFrame(list(panel.items()), "ref_id string, seq string"), spark.createDataFrame([(s,) for s in sequences], "seq string")


def plain_mismatches(panel, sequences, v):
    out = set()
    for seq in sequences:
        for strand, own in (("+", seq), ("-", mirrored(seq))):
            for ref, text in panel.items():
                for p in range(len(text) - len(seq) + 1):
                    window = text[p : p + len(seq)]
                    mm = sum(a != b for a, b in zip(own, window))
                    if mm <= v and "N" not in window:
                        out.add((seq, ref, p, strand, mm))
    return out


@pytest.mark.parametrize("v", [2, 3])
@pytest.mark.parametrize("broadcast_rows", [0, 500_000])
def test_spaced_keys_find_all(spark, panel, sequences, v, broadcast_rows):
    refs, reads = frames(spark, panel, sequences)
    hits = align.mismatch_join(reads, align.build_index(refs, min_length=15), v, "all", 15, broadcast_rows).collect()
    got = [(h.seq, h.ref_id, h.pos, h.strand, h.mm) for h in hits]
    assert len(got) == len(set(got)) and set(got) == plain_mismatches(panel, sequences, v)


def test_tiers_cover_all_lengths():
    for below in (22, 33, 45, 90):
        tiers = align.spaced_tiers(15, below, 5)
        assert [n for _, a, b in tiers for n in range(a, b + 1)] == list(range(15, below)) and all(5 * s <= a for s, a, _ in tiers)
    with pytest.raises(ValueError):
        align.spaced_tiers(4, 20, 5)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_edits(panel, sequences, tiers):
    out = set()
    for seq in sequences:
        allowed = [e for n, e in tiers if len(seq) >= n]
        if not allowed:
            continue
        e = allowed[-1]
        for strand, own in (("+", seq), ("-", mirrored(seq))):
            for ref, text in panel.items():
                best = {}
                for p in range(len(text)):
                    for n in range(max(1, len(seq) - e), len(seq) + e + 1):
                        window = text[p : p + n]
                        if p + n <= len(text) and "N" not in window and (d := distance(own, window)) <= e:
                            best[p] = min(best.get(p, (99,)), (d, abs(n - len(seq)), p + n))
                for p, (d, _, end) in best.items():
                    if not any(abs(q - p) <= 2 * e and (o[0], q) < (d, p) for q, o in best.items()):
                        out.add((seq, ref, p, end, strand, d))
    return out


@pytest.mark.parametrize("broadcast_rows", [0, 500_000])
def test_edits_find_all_loci(spark, panel, sequences, broadcast_rows):
    few = sequences[::4] + ["ACACACACACACACACACACAC"]
    small = {r: t[:200] for r, t in panel.items()}
    refs, reads = frames(spark, small, few)
    index = align.build_index(refs, k=8)
    tiers = ((18, 1), (33, 2))
    got = [(h.seq, h.ref_id, h.pos, h.end, h.strand, h.edits) for h in edits.edit_join(reads, index, tiers, "all", broadcast_rows).collect()]
    want = plain_edits(small, few, tiers)
    assert len(got) == len(set(got)) and set(got) == want and any(e[3] - e[2] != len(e[0]) for e in want)
    best = {}
    for h in want:
        best[h[0]] = min(best.get(h[0], 9), h[5])
    strata = edits.edit_join(reads, index, tiers, "best_strata", broadcast_rows).collect()
    assert {(h.seq, h.ref_id, h.pos, h.end, h.strand, h.edits) for h in strata} == {h for h in want if h[5] == best[h[0]]}


def test_edits_on_large_references_meet_few_tiles(spark):
    """The search in buckets finds the loci of the search by seeds from few of its places."""
    rnd = random.Random(41)
    base = lambda n: "".join(rnd.choice("ACGT") for _ in range(n))
    refs = {"a": base(3000), "b": base(400) + "N" + base(35) + "NN" + base(60), "c": "AC" * 60 + base(20) + "A" * 40, "d": base(45)}
    asked = set()
    for _ in range(500):
        text = refs[rnd.choice("abbccd")]
        n = rnd.choice([20, 21, 24, 32, 33, 34, 40, 45, 66, 75])
        at = rnd.randint(0, max(0, len(text) - n))
        read = list(text[at:at + n])
        for _ in range(rnd.randint(0, 3)):
            place = rnd.choice([0, 1, len(read) - 1, len(read) // 2, rnd.randrange(len(read))])
            read[place] = rnd.choice(["", "A", "C", "G", "T", "N", read[place] + rnd.choice("ACGT")])
        read = "".join(read)
        read = read.translate(str.maketrans("ACGTN", "TGCAN"))[::-1] if rnd.random() < 0.5 else read
        if len(read) >= 20:
            asked.add(read if rnd.random() < 0.9 else read.lower())
    reads = spark.createDataFrame([(r,) for r in sorted(asked)], "seq string")
    panel = spark.createDataFrame(list(refs.items()), "ref_id string, seq string")
    index = align.build_index(panel, k=7, max_length=90)
    one, two = (sorted(map(tuple, edits.edit_join(reads, index, ((20, 1), (33, 2)), "all", n).collect())) for n in (500_000, 0))
    assert one == two and len(one) > 200
    steps = reads.filter("length(seq) >= 33 and not upper(seq) rlike 'ACACAC|GTGTGT|AAAAAA|TTTTTT'").selectExpr("seq", "cast(floor(length(seq) / 3) as int) as _step")
    seeded, sifted = (f(steps, index, 2, 0).count() for f in (edits._seeded, edits._sifted))
    assert sifted * 2 < seeded


def test_edits_say_what_cannot_be_searched(spark, panel):
    refs, reads = frames(spark, panel, ["ACGTACGTACGTACGTACGT"])
    with pytest.raises(ValueError, match="need seeds"):
        edits.edit_join(reads, align.build_index(refs, k=12), ((18, 1),))
    with pytest.raises(ValueError, match="report"):
        edits.edit_join(reads, align.build_index(refs, k=8), ((18, 1),), "none")


def test_index_is_kept_between_sessions(spark, panel, sequences, tmp_path):
    refs, reads = frames(spark, panel, sequences)
    folder = str(tmp_path / "kept")
    built = align.build_index(refs, min_length=15)
    first = seedstore.kept_or_built(spark, refs, "kept_panel", folder, "2024-1")
    want = {tuple(h) for h in align.mismatch_join(reads, built, 1, "all", 15).collect()}
    assert {tuple(h) for h in align.mismatch_join(reads, first, 1, "all", 15).collect()} == want
    seedstore.drop_index(spark, "kept_panel")
    again = seedstore.kept_or_built(spark.newSession(), refs, "kept_panel", folder, "2024-1")
    hits = align.mismatch_join(reads, again, 1, "all", 15, broadcast_rows=0)
    assert {tuple(h) for h in hits.collect()} == want
    said = seedstore.read_manifest(spark, folder)
    assert said["release"] == "2024-1" and said["seed_rows"] == again.seeds.count() and said["k"] == built.k
    with pytest.raises(ValueError, match="keeps release"):
        seedstore.kept_or_built(spark, refs, "kept_panel", folder, "2025-1")
    seedstore.drop_index(spark, "kept_panel")


def test_kept_seeds_are_not_shuffled(spark, panel, sequences, tmp_path):
    refs, reads = frames(spark, panel, sequences)
    folder = str(tmp_path / "kept")
    seedstore.save_index(align.build_index(refs, min_length=15), "kept_plan", folder, "1", 4)
    index = seedstore.load_index(spark, folder)
    probes = align.read_probes(reads, index.k, 1, 15, index.max_length)
    plan = align.seed_matches(probes, index, 0)._jdf.queryExecution().executedPlan().toString()
    join = plan.split("SortMergeJoin")[1].splitlines()
    scan = next(i for i, line in enumerate(join) if "kept_plan_seeds" in line and "Scan" in line)
    side = len(join[scan]) - len(join[scan].lstrip(" :"))
    above = [line for line in join[:scan] if "Exchange" in line and "+-" in line]
    assert "Bucketed: true" in join[scan] and side
    assert all(":" in line[: line.index("Exchange")] for line in above)  # only the reads' side has one
    seedstore.drop_index(spark, "kept_plan")


def test_palindromes_match_both_strands(spark):
    refs, reads = frames(spark, {"a": "TTTACGCGTAACCGTTT"}, ["ACGCGT"])
    hits = align.mismatch_join(reads, align.build_index(refs, k=6, min_length=6), 0, "all", 6).collect()
    assert {(h.pos, h.strand) for h in hits} == {(3, "+"), (3, "-")}


def test_density_weights(spark):
    rng = random.Random(2)
    hits = [(f"u{i}", rng.choice("xy"), rng.randrange(400), rng.choice("+-"), 0) for i in range(60)]
    hits += [(f"m{i % 25}", rng.choice("xyz"), rng.randrange(400), rng.choice("+-"), 1) for i in range(80)]
    hits = sorted(set(hits))
    table = spark.createDataFrame(hits, "seq string, ref_id string, pos bigint, strand string, mm int")
    amount = {h[0]: len(h[0]) + h[2] % 3 for h in hits}
    n = {s: sum(h[0] == s for h in hits) for s in amount}
    for abundance in (None, spark.createDataFrame(list(amount.items()), "seq string, n bigint")):
        got = {(r.seq, r.ref_id, r.pos, r.strand): r.weight for r in counts.density_weights(table, 20, abundance=abundance).collect()}
        near = {h: sum((1 if abundance is None else amount[u[0]]) for u in hits if n[u[0]] == 1 and u[1] == h[1] and u[3] == h[3] and abs(u[2] - h[2]) <= 20) for h in hits}
        for h in hits:
            total = sum(near[o] for o in hits if o[0] == h[0])
            if n[h[0]] == 1:
                assert got[h[:4]] == 1
            else:
                assert abs(got[h[:4]] - (near[h] / total if total else 1 / n[h[0]])) < 1e-9
        assert len(got) == len(hits)
    capped = counts.density_weights(table, 20, max_mismatches=0)
    assert capped.filter("mm > 0").count() == 0
    collapsed = spark.createDataFrame([("S", s, 2) for s in amount], "sample string, seq string, n bigint")
    total = counts.fractional_counts(collapsed, table, counts.density_weights(table, 20)).agg(F.sum("reads")).first()[0]
    assert abs(total - 2 * len(amount)) < 1e-6


def test_dimensions_from_ids(spark):
    want = {
        "Homo_sapiens_tRNA-Ala-AGC-1-1": ("genomic", "Homo_sapiens", "Ala", "AGC"),
        "Mus_musculus_nmt-tRNA-Gln-UUG-3-1": ("genomic", "Mus_musculus", "Gln", "TTG"),
        "Saccharomyces_cerevisiae_S288c_tRNA-iMet-CAT-1-2": ("genomic", "Saccharomyces_cerevisiae_S288c", "iMet", "CAT"),
        "tdbD00000123|Escherichia_coli|562|Ala|TGC": ("curated", "Escherichia_coli", "Ala", "TGC"),
        "chr6.trna34-SeCTCA": ("predicted", None, "SeC", "TCA"),
        "contig_1.2.trna1-fMetCAT": ("predicted", None, "fMet", "CAT"),
        "unnamed": (None,) * 4, "": (None,) * 4, "tRNA-Ala": (None,) * 4,
    }
    ids = spark.createDataFrame([(i,) for i in want] * 2, "ref_id string")
    phyla = spark.createDataFrame([("Homo_sapiens", "Chordata")], "species string, phylum string")
    got = {r.ref_id: r for r in trna_dimensions(ids, phyla).collect()}
    assert {i: (r.origin, r.species, r.aa, r.anticodon) for i, r in got.items()} == want
    assert got["Homo_sapiens_tRNA-Ala-AGC-1-1"].phylum == "Chordata" and got["unnamed"].phylum is None


def test_misread_adapters(spark):
    adapter, rng = "TGGAATTCTCGGGTGCCAAGG", random.Random(8)
    texts = ["", "TGG", adapter, "ACGT" * 9]
    for _ in range(120):
        insert = "".join(rng.choice(BASES) for _ in range(rng.randint(0, 30)))
        texts.append(insert + changed(rng, adapter, rng.randint(0, 3))[: rng.randint(0, 21)])
    df = spark.createDataFrame([(t, "I" * len(t)) for t in sorted(set(texts))], "seq string, qual string")

    def plain(text, share):
        for at in range(len(text) - 3):
            part = text[at : at + len(adapter)]
            if sum(a != b for a, b in zip(part, adapter)) <= int(len(part) * share + 1e-9):
                return text[:at]
        return text

    for share in (0.0, 0.1, 0.2):
        got = sorted((r.seq, len(r.qual)) for r in rd.trim_adapter_with_errors(df, adapter, share).collect())
        assert got == sorted((plain(t, share), len(plain(t, share))) for t in set(texts))
