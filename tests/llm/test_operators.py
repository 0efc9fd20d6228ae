"""Every operator against a plain version, on odd rows and on an empty table."""

import hashlib
import random
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from corpus import SCHEMA, odd_rows, random_rows, row  # noqa: E402

from ribolake.llm import ann, licenses, lines, mixing, ngram_join, packing, pii, quality, rules, sharding  # noqa: E402
from ribolake.llm.graph import components  # noqa: E402
from ribolake.llm.packing import tokenizer_path  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="module")
def many(spark):
    return spark.createDataFrame(random_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, int(i % 3 > 0), 0) for i in range(120)] + [(5, 1, 0), (5, 0, 0), (None, 1, 0), (6, None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


# --- mixing


def test_mixture_targets_and_repeats(odd, many):
    for docs in (odd, many):
        got = mixing.mixture(docs).collect()
        rows = docs.collect()
        assert len(got) == len(rows)
        sizes = Counter()
        for r in rows:
            sizes[r.source] += len(WORD.findall(r.text or ""))
        order = sorted(sizes, key=lambda s: (s is None, s or ""))
        weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
        target, open_, budget = {}, set(sizes), 1.5 * sum(sizes.values())
        while open_:
            share = budget / sum(weights[s] for s in open_)
            full = {s for s in open_ if share * weights[s] >= 2 * sizes[s]}
            for s in full or open_:
                target[s] = 2.0 * sizes[s] if full else share * weights[s]
            budget -= sum(target[s] for s in full)
            open_ -= full or open_
        taken, largest = Counter(), Counter()
        by_key = {"b" if s is None else "a" + s: s for s in sizes}
        for r in got:
            s = by_key[r.skey]
            assert r.source_size == sizes[s] and abs(r.target - target[s]) < 1e-6 and 0 <= r.repeats <= 2
            taken[s] += r.size * r.repeats
            largest[s] = max(largest[s], r.size)
        assert all(abs(taken[s] - target[s]) <= 0.5 * largest[s] + 1e-6 for s in sizes)
        assert sorted(got, key=str) == sorted(mixing.mixture(docs).collect(), key=str)


def test_mixed_documents_keep_columns(odd, empty):
    out = mixing.mixed_documents(odd)
    assert out.columns == odd.columns
    expected = sum(r.repeats for r in mixing.mixture(odd).collect())
    assert out.count() == expected
    assert mixing.mixed_documents(empty).count() == 0 and mixing.mixture(empty).count() == 0


def test_mixture_of_equal_rows_meets_its_target(spark):
    text = " ".join(["word"] * 10)
    rows = [row(None, text)] * 1000 + [row(None, "other words " + str(i), "en", "src2") for i in range(30)] + [row(7, text, "en", "src3")] * 11
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = mixing.mixture(docs).collect()
    taken, target = Counter(), {}
    for r in got:
        taken[r.skey] += r.size * r.repeats
        target[r.skey] = r.target
    assert len(got) == len(rows) and all(abs(taken[s] - target[s]) <= 5 for s in target) and max(r.repeats for r in got) <= 2
    mixed = Counter(r.source for r in mixing.mixed_documents(docs).collect())
    assert {"a" + s: n for s, n in mixed.items()} == {s: sum(r.repeats for r in got if r.skey == s) for s in target if taken[s]}


# --- packing


def test_packing_of_a_long_blank_run(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    texts = {1: " " * 1_500_000, 2: "a" + "\n" * 300_000 + "b", 3: "stone"}
    docs = spark.createDataFrame([row(i, t) for i, t in texts.items()], SCHEMA)
    ids = {}
    for r in sorted(packing.packed(docs, tokenizer_path(), with_ids=True).collect(), key=lambda r: (r.doc_id, r.start)):
        ids.setdefault(r.doc_id, []).extend(r.ids)
    assert ids == {i: [*plain.encode(t, add_special_tokens=False).ids, 0] for i, t in texts.items()}


def test_packing_round_trip(odd, empty):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    plain.encode_special_tokens = True
    got = packing.packed(odd, tokenizer_path(), length=64, with_ids=True).collect()
    whole = {}
    for r in got:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        assert r.offset + r.length <= 64
    stream = sorted(got, key=lambda r: (r.sequence_id, r.offset))
    at = 0
    for r in stream:
        assert r.sequence_id * 64 + r.offset == at
        at += r.length
    documents, ids = [], []
    for r in stream:
        ids += r.ids
        if r.start + r.length == r.doc_tokens:
            documents.append((r.doc_id, tuple(ids)))
            ids = []
    expected = [(r.doc_id, (*plain.encode(r.text or "", add_special_tokens=False).ids, 0)) for r in odd.collect()]
    assert Counter(documents) == Counter(expected) and not whole
    assert packing.packed(empty, tokenizer_path()).count() == 0


def test_encoder_equals_tokenizers():
    encoder = packing.encoder(tokenizer_path())
    rng = random.Random(1)
    signs = " \n\t\r\x0b\x1c\x85  　aZé'sß1٣.!?漢😀​<|endoftext|>"
    for _ in range(300):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 40)))
        assert np.frombuffer(encoder.encode([text])[0], "<u2").tolist() == encoder._slow_ids(text)


def test_added_tokens_are_one_id():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    encoder = packing.encoder(tokenizer_path())
    for text in ("stone river", "stone<|endoftext|>river", "<|endoftext|>", " <|endoftext|> <|endoftext|>\n", "<|endoftext|"):
        ids = np.frombuffer(encoder.encode([text])[0], "<u2").tolist()
        assert ids == plain.encode(text, add_special_tokens=False).ids
        assert ids.count(50256) == text.count("<|endoftext|>")


# --- sharding


def test_hilbert_curve_visits_neighbours(spark):
    from pyspark.sql import functions as F

    cells = spark.range(8).select(F.col("id").alias("x")).crossJoin(spark.range(8).select(F.col("id").alias("y"))).crossJoin(
        spark.range(8).select(F.col("id").alias("z")))
    path = cells.withColumn("h", sharding.hilbert_index([F.col("x"), F.col("y"), F.col("z")], 3)).orderBy("h").collect()
    assert [r.h for r in path] == list(range(512))
    assert all(abs(a.x - b.x) + abs(a.y - b.y) + abs(a.z - b.z) == 1 for a, b in zip(path, path[1:]))


def test_shards_are_near_equal_runs(odd, many, empty):
    for docs in (odd, many):
        got = sharding.sharded(docs).collect()
        rows = docs.collect()
        key = lambda r: (r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode()))
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(map(key, rows))
        total, largest = sum(r.size for r in got), max(r.size for r in got)
        for shard in range(16):
            own = sorted(r.slot for r in got if r.shard == shard)
            assert own == list(range(len(own)))
            assert abs(sum(r.size for r in got if r.shard == shard) - total / 16) <= largest
    assert sharding.sharded(empty).count() == 0


def test_shards_narrow_the_dimensions(many):
    placed = sharding.sharded(many)
    bounds = sharding.pruning_bounds(many, placed).collect()
    spans = [r.max_size - r.min_size for r in bounds]
    sizes = [r.size for r in placed.collect()]
    assert np.mean(spans) < 0.8 * (max(sizes) - min(sizes))


# --- personal data


def plain_spans(text):
    found = []
    for order, (kind, pattern) in enumerate(pii.BASE.items()):
        for m in re.finditer(pattern, text):
            v = m.group()
            digits = re.sub("[^0-9]", "", v)
            if kind == "ip" and any(int(x) > 255 for x in v.split(".")):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            if kind == "card":
                odd_sum = sum(int(c) for c in digits[-1::-2]) + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
                if not 14 <= len(digits) <= 19 or odd_sum % 10:
                    continue
            found.append((m.start(), order, m.end(), kind))
    return sorted(found)


def test_pii_equals_plain_patterns(spark, odd, empty):
    rng = random.Random(2)
    bits = ["a.b@c.de", "x@y", "@", "1.2.3.4", "256.1.1.1", "00012.3.4.5.6.7.8.9", "4111 1111 1111 1111", "4111-1111-1111-1112",
            "+49 (30) 123-456-78", "+1", "-", " ", ".", "7", "é", "漢", "+", "m@n.o_p@q.r", "12", "\n", "  ", "5500005555555559", "a" * 50]
    rows = [row(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 30)))) for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA).union(odd)
    texts = Counter((r.doc_id, r.text) for r in docs.collect())
    got = pii.digest(pii.found_pii(docs)).collect()
    expected = Counter()
    for (doc_id, text), n in texts.items():
        base = plain_spans(text or "")
        joined = ",".join(f"{k}:{s}:{e}" for s, _, e, k in base)
        counts = Counter(k for *_, k in base)
        expected[(doc_id, *[counts[k] for k in pii.BASE], hashlib.sha256(joined.encode()).hexdigest())] += n
    assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == expected
    assert pii.found_pii(empty).count() == 0


def test_pii_added_kinds_and_scores(spark):
    text = "Pay to GB82WEST12345698765432 or GB82WEST12345698765433. ssn 123-45-6789; " + "of that, " * 6 + "part 123-45-6780"
    spans = pii.found_pii(spark.createDataFrame([row(1, text)], SCHEMA)).first().found
    assert [(s.kind, s.value) for s in spans] == [("iban", "GB82WEST12345698765432"), ("id_number", "123-45-6789")]
    near = "call +49 30 12345678" + " " * 60 + "+49 30 12345678"
    first, second = pii.found_pii(spark.createDataFrame([row(1, near)], SCHEMA)).first().found
    assert first.score > second.score


def test_pii_secrets_need_context_and_even_characters(spark):
    key = "9c8b45435718dcc700c184a7e303cdc64c6a8f7f"
    texts = {
        1: f'token = "{key}"', 2: f"commit {key}", 3: f"the token of commit {key}", 4: key, 5: f"{key} is the api key",
        6: "token " + "ab1" * 14, 7: "password: " + "correcthorsebatterystaplexyz", 8: "bearer " + (key * 13)[:512], 9: "bearer " + (key * 13)[:513],
        10: f"token {'.' * 41}{key}", 11: f"passwd {key[:19]}", 12: f"SECRET={key.upper()}\u00e9", 13: f"token -{key[:20]}_",
    }
    got = {r.doc_id: r for r in pii.digest(pii.found_pii(spark.createDataFrame([row(i, t) for i, t in texts.items()], SCHEMA))).collect()}
    assert {i for i, r in got.items() if r.n_secret} == {1, 5, 8, 12, 13}
    assert got[1].spans == "secret:9:49" and got[1].scores == "60" and got[1].n_spans == 1 and got[5].spans == "secret:0:40"
    assert got[4].spans == got[4].scores == "" and got[4].base_sha256 == hashlib.sha256(b"").hexdigest()


def test_pii_context_on_both_sides_raises_and_lowers(spark):
    text = ["10.0.0.1", "server 10.0.0.1", "10.0.0.1 is the host", "version 10.0.0.1", "server version 10.0.0.1", "order 123-45-6789, ssn", "ssn 123-45-6789"]
    found = {r.doc_id: [round(s.score, 2) for s in r.found] for r in pii.found_pii(spark.createDataFrame([row(i, t) for i, t in enumerate(text)], SCHEMA)).collect()}
    assert [found[i] for i in range(7)] == [[0.6], [0.9], [0.9], [0.3], [0.6], [], [0.6]]


def test_pii_long_runs_are_fast(spark):
    rows = [row(1, "a" * 200_000), row(2, "1" * 200_000), row(3, "a@b" + ".c" * 50_000), row(4, "1 " * 100_000)]
    got = {r.doc_id: r for r in pii.digest(pii.found_pii(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert got[3].n_email == 1 and got[1].n_card == got[2].n_card == got[4].n_card == 0


# --- quality rules


def plain_counts(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(8)}
    filled = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(filled) - len(set(filled)), len(covered))


def test_rule_counts(odd, many, empty, labels):
    for docs in (odd, many):
        got = Counter(
            (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
            for r in rules.judged(docs, labels).collect()
        )
        expected = Counter()
        for r in docs.collect():
            c = plain_counts(r.text or "")
            expected[(r.doc_id, *c, c[0] < 20 or 100 * c[4] > 30 * c[0])] += 1
        assert got == expected
    assert rules.judged(empty, labels).count() == 0
    assert all(r.kept != r.base_failed for r in rules.judged(many, labels.limit(0)).collect())


def test_binomial_tail_is_exact(spark):
    from math import comb, log

    from pyspark.sql import functions as F

    for n, k, p in ((50, 0, 0.01), (200, 3, 0.02), (1000, 40, 0.05)):
        want = log(sum(comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1)))
        got = spark.range(1).select(rules.binomial_tail(F.lit(n).cast("bigint"), F.lit(k).cast("bigint"), p)).first()[0]
        assert got == pytest.approx(want, rel=1e-9)


def test_cutoffs_bound_false_rejections(spark):
    rng = random.Random(4)
    rows = [("en", rng.choice([0] * 97 + [60] * 3), 0, 0, 500) for _ in range(20_000)] + [("de", 0, 0, 0, 500)] * 30
    holdout = spark.createDataFrame(rows, "stratum string, symbol_share int, dup_line_share int, repeat_share int, word_length int")
    got = {r.stratum: r for r in rules.certified(holdout).collect()}
    assert "de" not in got  # too few labels
    assert got["en"].step == 5 and got["en"].symbol_share_cutoff == 70 and got["en"].dup_line_share_cutoff is None and got["en"].word_length_cutoff is None


def test_a_few_hundred_labels_certify(spark):
    """437 good labels without a loss are enough for four strata, 436 are not."""
    rows = [(s, 0, 0, 0, 500) for s, n in (("a", 437), ("b", 436), ("c", 20), ("d", 1)) for _ in range(n)]
    holdout = spark.createDataFrame(rows, "stratum string, symbol_share int, dup_line_share int, repeat_share int, word_length int")
    assert [(r.stratum, r.step) for r in rules.certified(holdout).collect()] == [("a", rules.STEPS)]


def test_certified_rules_reject_junk(spark):
    good = [row(i, " ".join(f"word{i}x{j}" for j in range(30))) for i in range(400)]
    bad = [row(1000 + i, " ".join(f"##$$ word{i}x{j}" for j in range(30))) for i in range(40)]
    marks = [(r[0], 1, 0) for r in good] + [(r[0], 0, 0) for r in bad]
    docs, marked = spark.createDataFrame(good + bad, SCHEMA), spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    kept = {r.doc_id for r in rules.judged(docs, marked).collect() if r.kept}
    assert kept == {r[0] for r in good}


# --- Jaccard join


def shingle_set(text, n):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(len(words) - n, 0) + 1))


def plain_components(rows, n, share):
    sets = [shingle_set(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= share * len(a | b):
                root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(ids.get(find(i), d), d)
    return Counter((d, len(sets[i]), d if not sets[i] else ids.get(find(i))) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("n,share", [(3, 90), (5, 80), (1, 50)])
def test_join_equals_all_pairs(odd, many, n, share):
    for docs in (odd, many):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        got = ngram_join.joined(docs, n, share).collect()
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain_components(rows, n, share)


def test_join_of_many_near_copies(spark):
    """Copies of one text with changes that link some and not others, and small sets."""
    rng = random.Random(8)
    texts = []
    for size in (12, 25, 60, 110):
        base = [f"w{rng.randint(0, 999)}" for _ in range(size)]
        for _ in range(60):
            words = list(base)
            for _ in range(rng.randint(0, max(1, size // 25))):
                words[rng.randrange(size)] = f"z{rng.randint(0, 30)}"
            texts.append(" ".join(words))
    rng.shuffle(texts)
    docs = spark.createDataFrame([row(i, t) for i, t in enumerate(texts)], SCHEMA)
    for n, share in ((3, 90), (5, 80)):
        got = ngram_join.joined(docs, n, share).collect()
        want = plain_components(list(enumerate(texts)), n, share)
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want


def test_join_of_two_classes_beside_a_far_pivot(spark):
    """Two sets that link share one signature, and its pivot is a third set that links with neither."""
    rng = random.Random(11)
    word = lambda: f"w{rng.randint(0, 10**6)}"

    def emitted(sets):
        rows, tokens = next(ngram_join.token_sets(pa.array([" ".join(x) for x in sets]), 1))[2:]
        sizes = np.bincount(rows, minlength=len(sets))
        owner, sigs = ngram_join.signatures(rows, tokens, sizes, 90)
        return [set(sigs[owner == i].tolist()) for i in range(len(sets))]

    for _ in range(50):
        both = [word() for _ in range(38)]
        u, v = both + [word(), word()], both + [word(), word()]
        a, b = emitted([u, v])
        # The words that the shared signatures need, and others that leave them as they are.
        needed = [w for w, left in zip(both, emitted([[x for x in u if x != w] for w in both])) if not a & b <= left]
        fresh = [word() for _ in range(200)]
        fresh = [w for w, more in zip(fresh, emitted([[*u, w] for w in fresh])) if a & b <= more][: 41 - len(needed)]
        p, q = needed + fresh[:-1], needed + fresh[1:]
        if len(needed) < 30 and len(p) == 40:
            c, d = emitted([p, q])
            if a & b and a & b < c & d:
                break
    else:
        raise AssertionError("no such sets")
    texts = [" ".join(x) for x in (u, v, p, q)]
    docs = spark.createDataFrame([row(i, t) for i, t in enumerate(texts)], SCHEMA)
    got = ngram_join.joined(docs, 1, 90).collect()
    want = plain_components(list(enumerate(texts)), 1, 90)
    assert sorted(want) == [(0, 40, 0), (1, 40, 0), (2, 40, 2), (3, 40, 2)]
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want


def test_join_in_small_chunks(many, monkeypatch):
    monkeypatch.setattr(ngram_join, "CHUNK_TOKENS", 300)
    rows = [(r.doc_id, r.text) for r in many.collect()]
    got = ngram_join.joined(many, 5, 80).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain_components(rows, 5, 80)


def test_search_tasks_hold_two_chunks(spark, monkeypatch):
    """One group of many chunks and many small groups: no pandas group gets more than two chunks."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(ngram_join, "CHUNK_TOKENS", 64 * ngram_join.VECTOR)
    members = spark.range(1000).selectExpr("0L group", "id cls", "id root").union(
        spark.range(2000).selectExpr("1 + id div 4 group", "5000 + id cls", "5000 + id root"))
    sets = members.select("cls", F.lit(10).cast("bigint").alias("n"), F.array_repeat(F.lit(0), ngram_join.VECTOR).alias("vector"))
    seen = []

    class Grouped:
        def __init__(self, grouped):
            self.grouped = grouped

        def applyInPandas(self, run, schema):
            seen.extend(r["count"] for r in self.grouped.count().collect())
            return self.grouped.applyInPandas(run, schema)

    frame = type(members)
    plain = frame.groupBy
    monkeypatch.setattr(frame, "groupBy", lambda self, *on: Grouped(plain(self, *on)) if {"query"} <= set(self.columns) else plain(self, *on))
    assert ngram_join.between_roots(members, sets, 80, False).count() == 0
    # 1000 vectors in 16 chunks of some 62, dealt by hash, against 16 of queries; small groups of 7 rows.
    assert sum(seen) == 2 * 16 * 1000 - 16 + 500 * 7 and max(seen) <= 2 * 64 * 1.5


def test_tree_pages_never_lose_a_point():
    rng = np.random.default_rng(3)
    vectors = rng.poisson(3, (500, ngram_join.VECTOR))
    vectors[250:] = np.maximum(vectors[:250] + rng.integers(-1, 2, (250, ngram_join.VECTOR)) * (rng.random((250, ngram_join.VECTOR)) < 0.05), 0)
    sizes = vectors.sum(axis=1)
    tree = ngram_join.pages_of(vectors, sizes)
    for q in range(0, 500, 7):
        common = np.minimum(vectors, vectors[q]).sum(axis=1)
        want = set(np.flatnonzero(190 * common >= 90 * (sizes + sizes[q])))
        assert set(ngram_join.search_pages(vectors[q], sizes[q], tree, vectors, sizes, 90)) == want


def test_one_of_each_component(odd, many, empty):
    for docs in (odd, many):
        got = ngram_join.one_of_each(docs)
        assert got.columns == docs.columns
        rows = {(r.doc_id, r.text) for r in docs.collect()}
        want = plain_components(sorted(rows, key=str), 5, 80)
        kept = Counter((r.doc_id, r.text) for r in got.collect())
        assert {d for d, n, c in want if n and d is not None and d == c} == {d for d, t in kept if d is not None and shingle_set(t, 5)}
        assert all(n == 1 for (d, t), n in kept.items() if shingle_set(t, 5))
    assert ngram_join.one_of_each(empty).count() == 0 and ngram_join.joined(empty, 3, 90).count() == 0


def test_one_of_near_copies_under_one_id_or_none(spark):
    rng = random.Random(12)
    groups = []
    for _ in range(3):
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(80)]
        groups.append([" ".join(words), " ".join([*words, "more"]), " ".join([*words, "other"])])
    ids = [(5, 5, 7), (None, None, None), (5, None, 5)]
    rows = [row(i, t) for own, texts in zip(ids, groups) for i, t in zip(own, texts)]
    kept = ngram_join.one_of_each(spark.createDataFrame(rows + rows[:1] + rows[3:4], SCHEMA)).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["5", "5", "None"]
    assert [sum(r.text in texts for r in kept) for texts in groups] == [1, 1, 1]


def test_components_of_paths_and_stars(spark):
    rng = random.Random(6)
    links = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(5000, 5000)]
    rng.shuffle(links)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1400)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- repeated lines


def plain_dedup(rows, min_chars):
    """Texts after deleting every run that occurs earlier, by trying all runs."""
    docs = sorted({(r.doc_id, r.text) for r in rows if r.text}, key=lambda d: (d[0] is not None, d[0] or 0))
    seen, gone = {}, {d: set() for d in docs}
    for d in docs:
        filled = [(i, x) for i, x in enumerate(d[1].split("\n")) if WORD.search(x)]
        for a in range(len(filled)):
            chars, run = 0, ()
            for b in range(a, len(filled)):
                chars += len(filled[b][1])
                run = hash((run, filled[b][1]))
                if chars >= min_chars:
                    if run in seen:
                        gone[d] |= {i for i, _ in filled[a : b + 1]}
                    seen.setdefault(run, (d, a))
    return {d: "\n".join(x for i, x in enumerate(d[1].split("\n")) if i not in gone[d]) for d in docs}


def test_line_runs_equal_all_runs(odd, many, empty):
    for docs in (odd, many):
        for min_chars in (20, 100):
            rows = docs.collect()
            want = plain_dedup(rows, min_chars)
            got = lines.deduplicated(docs, min_chars).collect()
            assert Counter((r.doc_id, r.text) for r in got) == Counter(
                (r.doc_id, want[(r.doc_id, r.text)] if r.text else r.text) for r in rows
            )
    assert lines.deduplicated(empty).count() == 0


def test_remaining_documents(odd):
    out = lines.remaining(odd)
    assert out.columns == odd.columns
    kept = {r.doc_id: r for r in out.collect()}
    assert 6 in kept and 7 not in kept and kept[1].text is None and kept[2].text == ""
    assert all(r.n_chars == len(r.text) for r in kept.values() if r.text is not None)


# --- nearest neighbours


def test_forest_recall_and_order(spark):
    rng = np.random.default_rng(9)
    vectors = rng.standard_normal((1500, 24))
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(vectors)]
    rows += [(2000 + i, rows[7][1], 1) for i in range(300)] + [(7, rows[7][1], 1)]
    bad = [(3000, None, 1), (3100, [], 1), (3200, [0.0] * 24, 1), (3300, [float("nan")] * 24, 1), (3400, [None] + [1.0] * 23, 1),
           (None, [1.0] * 24, 1), (3500, [float("inf")] * 24, 1), (3600, [1.0, 2.0], 1)]
    docs = spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<double>, rank int")
    got = ann.nearest(docs, block=600).collect()
    everyone = np.array([r[1] for r in rows[:-1]])
    ids = np.array([r[0] for r in rows[:-1]])
    hits = total = 0
    for q in sorted({i for i in ids if i % 100 == 0}):
        distance = np.sqrt(((everyone - everyone[ids == q][0]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, distance)) if ids[i] != q][:10]
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in own] == sorted((r.score, r.vec_id) for r in own)
        for r in own:
            assert r.score == pytest.approx(distance[ids == r.vec_id][0], rel=1e-12)
        hits += len({r.vec_id for r in own} & set(ids[order]))
        total += 10
    assert hits / total >= 0.9
    assert ann.nearest(docs.limit(0)).count() == 0
    assert {r.query_id for r in got} == {i for i in ids if i % 100 == 0}


# --- quality classifier


def test_classifier_learns_and_holds_out(spark):
    rng = random.Random(7)
    rows, marks = [], []
    for i in range(600):
        good = i % 2
        text = " ".join(rng.choice(["stone", "river", "light", "paper"] if good else ["win!!", "cash###", "NOW", "free"]) for _ in range(40))
        rows.append(row(i, text))
        marks.append((i, good, 0))
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    got = quality.classified(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert held and all(r.predicted == r.doc_id % 2 for r in held)
    assert quality.accepted(docs, labels).count() == 300


def test_training_equals_a_plain_loop(spark):
    """Every update and the averaging, with plain numbers."""
    from math import exp, sqrt

    rng = random.Random(3)
    words = "stone river light paper win!! cash### NOW".split()
    rows = [row(i, " ".join(rng.choice(words[: 4 + 3 * (i % 2)]) for _ in range(6))) for i in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(60)], "doc_id bigint, quality int, toxic int")
    chosen = sorted((r.group, r.place, r.doc_id, r.text, r.label) for r in quality.sample(docs, marks, 12_000).collect())
    z, n = Counter(), Counter()
    alpha, beta, l1, l2 = quality.ALPHA, quality.BETA, quality.L1, quality.L2

    def weight(z, n, slot):
        shrink = 0.0 if slot == quality.DIM else l1
        if abs(z[slot]) <= shrink:
            return 0.0
        return -(z[slot] - (shrink if z[slot] > 0 else -shrink)) / ((beta + sqrt(n[slot])) / alpha + l2)

    for _ in range(2):
        states = []
        for group in sorted({c[0] for c in chosen}):
            own_z, own_n = Counter(z), Counter(n)
            for _, _, _, text, label in (c for c in chosen if c[0] == group):
                _, _, _, slots, values = next(iter(quality.features(pa.array([text], pa.large_string()))))
                x = dict(zip(slots.tolist(), values.tolist())) | {quality.DIM: 1.0}
                w = {slot: weight(own_z, own_n, slot) for slot in x}
                error = 1 / (1 + exp(-sum(w[slot] * x[slot] for slot in x))) - label
                for slot in x:
                    g = error * x[slot]
                    own_z[slot] += g - (sqrt(own_n[slot] + g * g) - sqrt(own_n[slot])) / alpha * w[slot]
                    own_n[slot] += g * g
            states.append((own_z, own_n))
        for slot in {s for _, own in states for s in own}:
            z[slot], n[slot] = (sum(state[i][slot] for state in states) / len(states) for i in (0, 1))
    got = quality.trained(docs, marks, rounds=2)
    want = np.array([weight(z, n, slot) for slot in range(quality.DIM + 1)])
    assert len({c[0] for c in chosen}) > 1 and np.abs(got - want).max() < 1e-9
    assert (got == quality.trained(docs, marks, rounds=2)).all()


def test_training_rows_are_bounded(spark):
    rows = [row(0, "one text")] * 3000 + [row(0, f"text {i}") for i in range(300)] + [row(3, "another text")] * 10
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    marks = spark.createDataFrame([(0, 1, 0), (3, 0, 0)], "doc_id bigint, quality int, toxic int")
    picked = quality.sample(docs, marks, 100).collect()
    assert 90 <= len(picked) <= 100 and len({r.group for r in picked}) > 1
    assert quality.sample(docs, marks, 10_000).count() == len([r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1])


def test_classifier_on_odd_rows(odd, empty, labels):
    got = quality.classified(odd, labels).collect()
    assert len(got) == len(odd_rows()) and all(0 <= r.score <= 1 for r in got)
    assert all(r.score == 0.5 for r in quality.classified(odd, labels.limit(0)).collect())
    assert quality.classified(empty, labels).count() == 0
    assert quality.accepted(odd, labels).columns == odd.columns


# --- licences


def test_licences_are_named_or_unknown(spark, many, odd, empty):
    extra = [
        row(1001, "some words\nReleased under the MIT License.\nmore"), row(1002, "Licensed under the Apache License, Version 2.0."),
        row(1003, "This work is licensed under the GNU General Public License, version 3."), row(1004, "Licensed under CC BY-NC 4.0."),
        row(1005, "A fishing licence was warranted by nobody in the village of stone cats"), row(1006, "plain stone river"),
    ]
    docs = many.union(spark.createDataFrame(extra, SCHEMA))
    got = {r.doc_id: r for r in licenses.scanned(docs).collect()}
    assert [got[i].families for i in range(1001, 1007)] == ["mit", "apache", "gpl", "cc-by-nc", "unknown", ""]
    assert got[1001].spans == "1:mit" and all(got[i].families == "" for i in range(120))
    assert len(licenses.scanned(odd).collect()) == len(odd_rows())
    assert licenses.scanned(empty).count() == 0


def test_licences_of_rows_that_share_an_id(spark, many):
    texts = ["Released under the MIT License.", "a plain text", "Licensed under the Apache License, Version 2.0"]
    extra = [row(i, t) for i in (None, 5000) for t in texts]
    got = licenses.scanned(many.union(spark.createDataFrame(extra, SCHEMA))).filter("doc_id is null or doc_id = 5000").collect()
    assert Counter((r.doc_id, r.families) for r in got) == Counter((i, f) for i in (None, 5000) for f in ("mit", "", "apache"))


def test_licences_without_a_cue_and_over_two_lines(spark, many):
    texts = ["Distributed under GPLv3", "under the terms of the GNU GPL", "Released under the MIT terms", "CC BY-SA 4.0", "under the Apache 2.0 terms"]
    wrapped = "Permission is hereby granted, free of charge, to any person obtaining\na copy of this software and associated documentation files, to deal in\nthe Software without restriction."
    extra = [row(1001 + i, f"stone river\n{t}\npaper light") for i, t in enumerate(texts)] + [row(1010, wrapped), row(1011, "License")]
    got = {r.doc_id: r for r in licenses.scanned(many.union(spark.createDataFrame(extra, SCHEMA))).collect()}
    assert [got[1001 + i].spans for i in range(5)] == ["1:gpl", "1:gpl", "1:mit", "1:cc-by-sa", "1:apache"]
    assert got[1010].spans == "0:mit" and got[1011].spans == "0:unknown"
    assert all(got[i].families == "" for i in range(120))


def test_licence_evidence_counts_lines_of_all_documents(spark):
    # A sample of about 2,000 documents by this hash would miss every line with the word.
    docs = spark.range(4100).select(F.col("id").alias("doc_id"), F.when(
        F.pmod(F.xxhash64("id", F.lit(5)), F.lit(2)) == 0, "stone river paper light"
    ).otherwise("stone river apache light").alias("text"))
    evidence = licenses.trained(docs)[2]["apache"]
    assert "apache" not in evidence and "the apache" in evidence


def test_licence_examples_are_all_lines(spark):
    def grams(line):
        words = re.findall(r"[^\W_]+", line.lower())
        return {*words, *map(" ".join, zip(words, words[1:]))}

    extra = ["Released under the MIT License.\nconditions of any stone", "conditions of any stone river paper light water", "License", "--- | ***"]
    texts = [t or "" for _, t, *_ in odd_rows() + random_rows()] + extra
    docs = spark.createDataFrame([row(i, t) for i, t in enumerate(texts)], SCHEMA)
    known = licenses.vocabulary(spark)
    templates = [grams(t) for of in licenses.TEMPLATES.values() for t in of]
    want = Counter()
    for line in "\n".join(texts).split("\n"):
        if WORD.search(line):
            own = grams(line)
            best = max(len(own & t) / min(len(own), len(t)) for t in templates) if own else 0
            want[None if best >= licenses.OVERLAP else 0.0, tuple(sorted(own & {*known}))] += 1
    rows = licenses.examples(docs, known).filter("label is null or label = 0").collect()
    got = Counter()
    for r in rows:
        got[r.label, tuple(r.grams)] += r.n
    phrase = ("any", "conditions", "conditions of", "of", "of any")
    assert got == want and got[None, phrase] == got[0.0, phrase] == 1
    assert {r.held for r in rows} == {True, False}


@pytest.mark.parametrize("share", [0.0, 0.001, 0.05, 0.5, 1.0])
def test_licence_score_is_an_exact_quantile(spark, share):
    rng = random.Random(4)
    scores = [(x, rng.randint(1, 9)) for x in [1 - rng.random() ** 8 / 10 for _ in range(3000)] + [0.1] * 50 + [0.9999] * 20]
    ordered = sorted((x for x, n in scores for _ in range(n)), reverse=True)
    want = max(0.5, ordered[min(int(share * len(ordered)), len(ordered) - 1)])
    assert licenses.quantile(spark.createDataFrame(scores, "score double, n bigint"), share) == want
    assert licenses.quantile(spark.createDataFrame([], "score double, n bigint"), share) == 0.5
