"""Conversation trie, Merkle manifest and decontamination against plain versions, on odd rows too."""

import hashlib
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from corpus import SCHEMA, odd_rows, random_rows, row  # noqa: E402

from ribolake.llm import decontam, merkle, trie  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
sha = lambda text: hashlib.sha256(text.encode()).hexdigest()


# --- conversations

TALK = "conv_id bigint, turn bigint, role string, text string, key string, depth int, n int"


def talks(n=90, seed=1):
    rng = random.Random(seed)
    lines = ["Hello", "How are you", "", "fine  thanks", "ünï cödé", "a b c d"]
    out = []
    for c in range(n):
        for t in range(rng.choice([0, 1, 2, 3, 5, 8])):
            out.append((c, t, rng.choice(["user", "system"]), rng.choice(lines[:3] if t < 3 else lines), "x", 1, 2))
    out += [(20, 0, "user", "Hello", "x", 1, 2)] * 2 + [(21, None, None, None, "x", 1, 2), (None, 1, "user", "nobody", "x", 1, 2), (-7, 3, "user", "below zero", "x", 1, 2)]
    out += [(1000, t, "user", f"long {t % 3}", "x", 1, 2) for t in range(600)] + [(1001, t, "user", f"long {t % 3}", "x", 1, 2) for t in range(590)]
    rng.shuffle(out)
    return out


def plain_trie(rows):
    own = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    built = {}
    for c in own:
        h, base = zlib.crc32(str(c).encode()) % 4, c - (abs(c) % 20) * (1 if c >= 0 else -1)
        built[c] = own.get(base, [])[:h] + own[c][h:]
    nodes = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    children, leaves, saved = Counter(), Counter(), Counter()
    for key in nodes:
        if key:
            children[key[:-1]] += 1
    for key, members in nodes.items():
        value = (len(members) - 1) * (len(WORD.findall(key[-1][1])) if key else 0)
        for d in range(len(key) + 1):
            leaves[key[:d]] += not children[key]
            saved[key[:d]] += value
    return sorted(
        (min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k],
         sha(",".join(str(c) for c in sorted(c for c in m if len(built[c]) == len(k)))))
        for k, m in nodes.items()
    )


@pytest.mark.parametrize("height", [2, 16])
def test_trie_equals_plain(spark, height):
    rows = talks()
    got = trie.trie(spark.createDataFrame(rows, TALK).repartition(5), height=height).collect()
    assert sorted(map(tuple, got)) == plain_trie(rows)


def test_trie_of_nothing_and_of_no_ids(spark):
    assert trie.trie(spark.createDataFrame([], TALK)).count() == 0
    assert trie.trie(spark.createDataFrame([(None, 1, "user", "x", "y", 1, 1)], TALK)).count() == 0


# --- Merkle manifest


def plain_manifest(rows):
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf_of = lambda r, text: sha("".join(map(enc, (r[0], r[3], r[2], r[4], text))))
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[3]].append((r[0] is not None, r[0] or 0, leaf_of(r, r[1]), r))

    def build(leaves):
        levels = [leaves]
        while len(levels[-1]) > 1:
            low = levels[-1]
            levels.append([sha("".join(low[i : i + 3])) for i in range(0, len(low), 3)])
        return levels

    def steps(levels, at):
        out = []
        for low in levels[:-1]:
            b = at - at % 3
            out.append(("".join(low[b:at]), "".join(low[at + 1 : b + 3])))
            at //= 3
        return out

    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: build([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in order}
    top = build([trees[s][-1][0] for s in order])
    out = []
    for i, s in enumerate(order):
        for at, (_, _, leaf, r) in enumerate(sorted(by_source[s], key=lambda x: x[:3])):
            path = steps(trees[s], at) + steps(top, i)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            value = leaf_of(r, r[1] if r[1] is None else r[1].replace("\n", "")) if hit else leaf
            for a, b in path:
                value = sha(a + value + b)
            out.append((str(r[0]), leaf, trees[s][-1][0], top[-1][0], sha("".join(a + b for a, b in path)), value, value == top[-1][0]))
    return sorted(out)


@pytest.mark.parametrize("height", [1, 2, 7])
def test_manifest_equals_plain(spark, height):
    rows = odd_rows() + random_rows(150) + [row(7000 + i, f"one\nmore {i}", "en", f"s{i % 11}") for i in range(40)]
    got = merkle.audited(spark.createDataFrame(rows, SCHEMA).repartition(3), height).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == plain_manifest(rows)


def test_manifest_of_nothing_and_of_one(spark):
    assert merkle.audited(spark.createDataFrame([], SCHEMA)).count() == 0
    one = [row(3, "a\nb")]
    assert sorted((str(r[0]), *r[1:]) for r in merkle.audited(spark.createDataFrame(one, SCHEMA)).collect()) == plain_manifest(one)


def test_places_in_the_log(spark):
    for n in (1, 2, 3, 4, 9, 10, 26, 27, 28, 100):
        order, level = [], 0

        def walk(level, at):
            if level:
                for i in range(3 * at, min(3 * at + 3, merkle.width(n, level - 1))):
                    walk(level - 1, i)
            order.append((level, at))

        walk(merkle.tree_height(n), 0)
        assert [merkle.postorder(level, at, n) for level, at in order] == list(range(len(order)))
    first, rounds, _, _ = merkle.manifest(spark.createDataFrame(random_rows(80), SCHEMA), 1)
    wanted = first.select("tree", "n", "at")
    log = {(r.tree, r.level, r["at"]): r.digest for part in rounds for r in part.collect()}
    found = merkle.proofs(rounds, wanted).collect()
    for r in found:
        assert log[r.tree, r.level, r.sibling] == r.digest
    want = Counter()
    for r in wanted.collect():
        for level in range(merkle.tree_height(r.n)):
            own = r["at"] // 3**level
            want[r.tree, r["at"]] += sum(i != own and i < merkle.width(r.n, level) for i in range(own // 3 * 3, own // 3 * 3 + 3))
    assert Counter((r.tree, r["at"]) for r in found) == +want


# --- decontamination

ITEMS = "item_id bigint, text string, words string, hash bigint, doc_id int"


def item(i, text):
    return (i, text, "w", 1, 2)


def low(text):
    return ITEM_WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_leaks(rows, items, window=10):
    windows = defaultdict(set)
    for i, text, *_ in items:
        ws = low(text)
        z = min(window, len(ws))
        for k in range(len(ws) - z + 1 if z else 0):
            windows[tuple(ws[k : k + z])].add(i)
    out = []
    for r in rows:
        ws, hit, ids = low(r[1]), set(), set()
        for z in {len(w) for w in windows}:
            for k in range(len(ws) - z + 1):
                if found := windows.get(tuple(ws[k : k + z])):
                    hit |= set(range(k, k + z))
                    ids |= found
        named = sorted(str(i) for i in ids if i is not None)
        out.append((str(r[0]), len(ws), len(hit), len(named), sha(",".join(named)), bool(hit)))
    return sorted(out)


def leak_tables():
    rng = random.Random(6)
    passage = lambda n: " ".join(rng.choice("alpha beta gamma delta Epsilon ZETA eta 42 größe".split()) + str(rng.randint(0, 30)) for _ in range(n))
    items = [item(i, passage(rng.choice([9, 12, 25]))) for i in range(12)]
    items += [item(100, "Tiny item"), item(101, "x"), item(102, ""), item(103, None), item(None, passage(14)), item(5, passage(11)), item(104, items[2][1]), item(105, items[2][1] + " more")]
    rows = odd_rows() + random_rows(60)
    for i in range(60):
        text = rng.choice(items)[1] or ""
        text = text.upper() if i % 3 == 0 else re.sub(" ", ", ", text) if i % 3 == 1 else " ".join(text.split(" ")[1:11])
        rows.append(row(2000 + i % 50, f"{passage(30)}. {text}! {passage(5)} {text if i % 4 == 0 else ''}"))
    rows += [row(None, items[0][1]), row(None, items[1][1] + " " + items[3][1]), row(3000, "a tiny ITEM, x"), row(3001, items[2][1])] + [row(None, items[0][1])] * 5
    return rows, items


@pytest.mark.parametrize("block", [400_000, 30])
def test_leaks_equal_plain(spark, block):
    rows, items = leak_tables()
    docs, benchmark = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, ITEMS)
    got = decontam.judged(docs, benchmark, block_windows=block).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == plain_leaks(rows, items)


def test_leaks_with_empty_tables(spark):
    rows, items = leak_tables()
    docs, benchmark = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, ITEMS)
    none = spark.createDataFrame([], ITEMS)
    assert decontam.judged(spark.createDataFrame([], SCHEMA), benchmark).count() == 0
    assert sorted((str(r[0]), *r[1:]) for r in decontam.judged(docs, none).collect()) == plain_leaks(rows, [])


def test_removal_of_spans_and_documents(spark):
    rows, items = leak_tables()
    docs, benchmark = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, ITEMS)
    dirty = [r for r in plain_leaks(rows, items) if r[-1]]
    kept = decontam.decontaminated(docs, benchmark, "documents")
    assert kept.columns == docs.columns and kept.count() == len(rows) - len(dirty)
    cut = decontam.decontaminated(docs, benchmark, "spans", 0.9)
    assert cut.columns == docs.columns
    texts = cut.collect()
    assert not any(r[-1] for r in plain_leaks([tuple(r) for r in texts], [i for i in items if len(low(i[1])) >= 10]))
    assert len(texts) == len(rows) - sum(r[2] > 0.9 * r[1] for r in dirty)
    left = Counter(len(low(r.text)) for r in texts)
    want = Counter(r[1] - r[2] for r in plain_leaks(rows, items) if not r[-1] or r[2] <= 0.9 * r[1])
    assert left == want
    with pytest.raises(ValueError):
        decontam.decontaminated(docs, benchmark, "lines")
