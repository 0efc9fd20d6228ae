"""Merkle manifest of a table: a postorder append log per source and proofs read from it.

A leaf is the checksum of a row. The leaves of a source, in the order of their ids, are cut
into aligned blocks of ``FANOUT ** HEIGHT``; a builder task takes a block, appends its nodes
in the order in which they are completed, and ends with the block's top. The tops of a
source are the leaves of the next round, so the rounds are the logarithm of the greatest
source to the base of the block, and a source of any size is spread over tasks that each
hold one block. The subroots of the sources are the leaves of one more tree.

Every node stands in the log of its tree at its postorder place. The place follows from
the number of leaves alone: what is complete at the last leaf below a node, level by level,
with partial runs closed up to the node's own level. Proofs are read the other way, from
the root down: a task takes a block's leaves, its log and the path of its top, and finds
all siblings by their places. ``proofs`` does the same by an equi-join for a few rows.

Defined results: null values are written ``-``; a null source is a tree of its own, before
the others, a null id comes before all ids and is never tampered with. Rows with one id are
ordered by their leaves, equal rows are leaves of their own. An empty table has no root and
no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import join_small, ship, stage
from .ordering import sorted_rows, starts, with_places

FANOUT = 3
HEIGHT = 7  # levels a builder completes: blocks of 2,187 leaves
TOP_TREE = ""
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """A value with its UTF-8 length in bytes, or ``-``."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaves(docs: DataFrame) -> DataFrame:
    """Tree, id, leaf, and the leaf after tampering where a row is tampered with."""
    values = {name: docs[name] for name in FIELDS}
    leaf = F.sha2(F.concat(*[field(v) for v in values.values()]), 256)
    cut = values | {"text": F.regexp_replace(values["text"].cast("string"), "\n", "")}
    hit = F.coalesce(F.crc32(values["doc_id"].cast("string").cast("binary")) % 2 == 0, F.lit(False))
    tampered = F.when(hit, F.sha2(F.concat(*[field(v) for v in cut.values()]), 256))
    # Trees are named by their source behind a letter: null first, then bytewise.
    tree = F.when(values["source"].isNull(), F.lit("a")).otherwise(F.concat(F.lit("b"), values["source"].cast("string")))
    return docs.select(tree.alias("tree"), values["doc_id"].alias("doc_id"), leaf.alias("leaf"), tampered.alias("tampered"))


def placed(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """Rows with their place ``at`` in their tree and the tree's number of leaves ``n``, written."""
    ordered = sorted_rows(rows, "tree", order, rows.columns, f"{label}-sorted")
    return stage(with_places(ordered, starts(ordered, "tree", f"{label}-starts"), "tree"), label)


def width(n: int, level: int) -> int:
    """Nodes of a level of a tree of ``n`` leaves."""
    return -(-n // FANOUT**level)


def tree_height(n: int) -> int:
    level = 0
    while width(n, level) > 1:
        level += 1
    return level


def postorder(level: int, at: int, n: int) -> int:
    """Place of a node in the log of a tree of ``n`` leaves, from 0."""
    begin, end = at * FANOUT**level, min((at + 1) * FANOUT**level, n)
    closed = sum(-(-end // FANOUT**j) for j in range(level + 1))
    j, earlier = level + 1, 0
    while FANOUT**j <= begin:
        earlier += begin // FANOUT**j
        j += 1
    return closed + earlier - 1


def postorder_column(level: Column, at: Column, n: Column, levels: int = 32) -> Column:
    """``postorder`` as an expression, for trees of fewer than ``FANOUT ** levels`` leaves."""
    power = lambda j: F.lit(1).cast("bigint") if j == 0 else F.lit(FANOUT**j)
    unit = F.element_at(F.array(*[power(j) for j in range(levels)]), (level + 1).cast("int"))
    begin, end = at * unit, F.least((at + 1) * unit, n)
    place = F.lit(-1).cast("bigint")
    for j in range(levels):
        place = place + F.when(level >= j, F.ceil(end / power(j))).otherwise(F.floor(begin / power(j)))
    return place


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


LOG = "tree string, n bigint, block bigint, level int, at bigint, place bigint, digest string"


def append_round(nodes: DataFrame, base: int, height: int) -> DataFrame:
    """Log rows of one round: ``nodes(tree, n, at, digest)`` are the nodes of level ``base``."""

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        tree, n = table.column("tree")[0].as_py(), table.column("n")[0].as_py()
        top = tree_height(n)
        open_runs: list[list[str]] = [[] for _ in range(height + 1)]
        done = []

        def append(level: int, at: int, value: str) -> None:
            done.append((base + level, at, postorder(base + level, at, n), value))
            if level < height and base + level < top:
                open_runs[level].append(value)
                if at % FANOUT == FANOUT - 1 or at == width(n, base + level) - 1:
                    run, open_runs[level] = open_runs[level], []
                    append(level + 1, at // FANOUT, digest(run))

        for at, value in zip(table.column("at").to_pylist(), table.column("digest").to_pylist()):
            append(0, at, value)
        count, block = len(done), table.column("block")[0].as_py()
        return pa.table({
            "tree": pa.array([tree] * count), "n": pa.array([n] * count, pa.int64()), "block": pa.array([block] * count, pa.int64()),
            "level": pa.array([d[0] for d in done], pa.int32()), "at": pa.array([d[1] for d in done], pa.int64()),
            "place": pa.array([d[2] for d in done], pa.int64()), "digest": pa.array([d[3] for d in done]),
        })

    ship(nodes.sparkSession)
    cut = nodes.select("tree", "n", "at", "digest", F.floor(F.col("at") / FANOUT**height).alias("block"))
    return cut.groupBy("tree", "block").applyInArrow(build, LOG)


def append_log(first: DataFrame, label: str, height: int = HEIGHT) -> list[DataFrame]:
    """The logs of all trees, one written table a round of builders."""
    rounds, nodes, base = [], first, 0
    largest = first.agg(F.max("n")).first()[0] or 0
    while True:
        log = stage(append_round(nodes, base, height), f"{label}-log")
        rounds.append(log)
        base += height
        if width(largest, base) <= 1:
            return rounds
        nodes = log.filter((F.col("level") == base) & (F.ceil(F.col("n") / FANOUT**base) > 1)).select("tree", "n", "at", "digest")


def tops(rounds: list[DataFrame], height: int = HEIGHT) -> DataFrame:
    """The root of every tree: its last node in postorder."""
    out = None
    for i, log in enumerate(rounds):
        # The round that holds a tree's root is the one in which it has a single block.
        last = log.filter(F.ceil(F.col("n") / FANOUT ** ((i + 1) * height)) <= 1).groupBy("tree").agg(
            F.max_by("digest", "place").alias("digest"), F.max("level").alias("level")
        ).select("tree", "digest")
        if i:
            last = last.join(rounds[i - 1].filter(F.ceil(F.col("n") / FANOUT ** (i * height)) > 1).select("tree").distinct(), "tree", "left_semi")
        out = last if out is None else out.unionByName(last)
    return out


STEPS = "array<struct<left:string,right:string>>"


def block_steps(at: int, n: int, base: int, known: dict[int, str], height: int) -> list[dict]:
    """Siblings before and after a node of level ``base``, level by level up to its block's top."""
    steps, top = [], tree_height(n)
    for level in range(base, min(base + height, top)):
        begin, size = at - at % FANOUT, width(n, level)
        steps.append({
            "left": "".join(known[postorder(level, i, n)] for i in range(begin, at)),
            "right": "".join(known[postorder(level, i, n)] for i in range(at + 1, min(begin + FANOUT, size))),
        })
        at //= FANOUT
    return steps


def _with_upper(log: DataFrame, upper: DataFrame) -> DataFrame:
    """A block's log rows and one row with the path of its top: ``upper(tree, block, steps)``."""
    # Columns are named anew, as both sides of a cogroup come from one table.
    own = [F.col(c).alias(c) for c in ("tree", "block", "n", "place", "digest")]
    return log.select(*own, F.lit(None).cast(STEPS).alias("steps")).unionByName(
        upper.select("tree", "block", F.lit(None).cast("bigint").alias("n"), F.lit(None).cast("bigint").alias("place"),
                     F.lit(None).cast("string").alias("digest"), "steps")
    )


def _opened(log: pa.Table) -> tuple[dict[int, str], list[dict], int]:
    known, upper, n = {}, [], 0
    for place, value, steps, leaves_ in zip(*(log.column(c).to_pylist() for c in ("place", "digest", "steps", "n"))):
        if place is None:
            upper = steps
        else:
            known[place], n = value, leaves_
    return known, upper, n


def node_paths(log: DataFrame, upper: DataFrame, base: int, height: int) -> DataFrame:
    """``tree``, ``block`` and the whole path of every node of level ``base``, as the next lower round takes it."""

    def run(nodes: pa.Table, rows: pa.Table) -> pa.Table:
        known, above, n = _opened(rows)
        ats = nodes.column("at").to_pylist()
        return pa.table({
            "tree": nodes.column("tree"), "block": nodes.column("at"),
            "steps": pa.array([block_steps(at, n, base, known, height) + above for at in ats], pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))),
        })

    nodes = log.filter(F.col("level") == base).select("tree", "block", "at")
    return nodes.groupBy("tree", "block").cogroup(_with_upper(log, upper).groupBy("tree", "block")).applyInArrow(
        run, f"tree string, block bigint, steps {STEPS}"
    )


def upper_paths(rounds: list[DataFrame], roots: DataFrame, label: str, height: int) -> DataFrame:
    """Paths of the tops of the lowest blocks; ``roots(tree, steps)`` has the paths of whole trees."""
    upper = None
    for i in reversed(range(len(rounds))):
        single = rounds[i].filter(F.ceil(F.col("n") / FANOUT ** ((i + 1) * height)) <= 1)
        if i:
            single = single.filter(F.ceil(F.col("n") / FANOUT ** (i * height)) > 1)
        whole = single.select("tree").distinct().join(roots, "tree").select("tree", F.lit(0).cast("bigint").alias("block"), "steps")
        # Trees that end in this round begin with the path of their root, the others with that of their blocks.
        upper = whole if upper is None else upper.unionByName(whole)
        if i:
            upper = stage(node_paths(rounds[i], upper, i * height, height), f"{label}-paths")
    return upper


def manifest(docs: DataFrame, height: int = HEIGHT) -> tuple[DataFrame, list[DataFrame], DataFrame, list[DataFrame]]:
    """Placed leaves, logs of the sources, placed subroots, and logs of the tree above them."""
    first = placed(stage(leaves(docs), "merkle-leaves"), ["doc_id", "leaf"], "merkle-placed")
    rounds = append_log(first.withColumnRenamed("leaf", "digest"), "merkle", height)
    subroots = stage(tops(rounds, height), "merkle-subroots").select(F.lit(TOP_TREE).alias("tree"), F.col("tree").alias("of"), "digest")
    second = placed(subroots, ["of"], "merkle-top")
    return first, rounds, second, append_log(second, "merkle-top", height)


def audited(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Every row with its leaf, subroot, root, proof checksum and the root its tampered leaf folds to."""
    first, rounds, second, above = manifest(docs, height)
    root = stage(tops(above, height), "merkle-root").select(F.col("tree").alias("_top"), F.col("digest").alias("root"))
    no_steps = root.select(F.col("_top").alias("tree"), F.array().cast(STEPS).alias("steps"))
    # Paths of the subroots, lowest round of the tree above them.
    upper = stage(upper_paths(above, no_steps, "merkle-top", height), "merkle-top-upper")
    of_top = node_paths(above[0], upper, 0, height).select(F.col("block").alias("at"), "steps")
    subroots = stage(
        second.join(of_top, "at").join(root, F.col("tree") == F.col("_top")).select(
            F.col("of").alias("tree"), "steps", F.col("digest").alias("subroot"), "root"
        ), "merkle-sources",
    )
    blocks = stage(upper_paths(rounds, subroots.select("tree", "steps"), "merkle", height), "merkle-upper")

    def check(rows: pa.Table, log: pa.Table) -> pa.Table:
        known, above_, n = _opened(log)
        proofs_, folded = [], []
        for at, value in zip(rows.column("at").to_pylist(), rows.column("shown").to_pylist()):
            steps = block_steps(at, n, 0, known, height) + above_
            proofs_.append(digest([s[side] for s in steps for side in ("left", "right")]))
            for s in steps:
                value = digest([s["left"], value, s["right"]])
            folded.append(value)
        return pa.table({
            "doc_id": rows.column("doc_id"), "tree": rows.column("tree"), "leaf": rows.column("leaf"),
            "proof_sha256": pa.array(proofs_, pa.string()), "folded_root": pa.array(folded, pa.string()),
        })

    rows = first.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "tree", "leaf", F.coalesce("tampered", "leaf").alias("shown"), "at",
        F.floor(F.col("at") / FANOUT**height).alias("block"),
    )
    checked = rows.groupBy("tree", "block").cogroup(_with_upper(rounds[0], blocks).groupBy("tree", "block")).applyInArrow(
        check, "doc_id bigint, tree string, leaf string, proof_sha256 string, folded_root string"
    )
    named = join_small(checked, subroots.select("tree", "subroot", "root"), ["tree"], subroots.count(), 256)
    return named.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def proofs(rounds: list[DataFrame], wanted: DataFrame) -> DataFrame:
    """Siblings, by level and place, of a few leaves ``wanted(tree, n, at)`` inside their trees.

    The places are computed, and the log is joined by tree and place.
    """
    log = rounds[0]
    for more in rounds[1:]:
        log = log.unionByName(more)
    levels = 32
    powers = F.array(*[F.lit(FANOUT**j) for j in range(levels)])
    unit = lambda level: F.element_at(powers, (level + 1).cast("int"))
    spread = (
        wanted.select("tree", "n", "at", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("level"))
        .filter(F.ceil(F.col("n") / unit(F.col("level"))) > 1)
        .withColumn("own", F.floor(F.col("at") / unit(F.col("level"))))
        .withColumn("sibling", F.explode(F.array(*[F.floor(F.col("own") / FANOUT) * FANOUT + i for i in range(FANOUT)])))
        .filter((F.col("sibling") != F.col("own")) & (F.col("sibling") < F.ceil(F.col("n") / unit(F.col("level")))))
        .withColumn("place", postorder_column(F.col("level"), F.col("sibling"), F.col("n")))
    )
    # A row of the log is in one round only, but for the tops, which begin the next round too.
    unique = log.groupBy("tree", "place").agg(F.first("digest").alias("digest"))
    return spread.join(unique, ["tree", "place"]).select("tree", "at", "level", "sibling", "digest")


def oracle_sql() -> str:
    from .trie import CRC_SQL

    enc = lambda c: f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')"
    crc = CRC_SQL.format("cast(doc_id as varchar)")
    values = " || ".join(enc(c) for c in FIELDS)
    tampered = " || ".join(enc("replace(text, chr(10), '')" if c == "text" else c) for c in FIELDS)
    forest = lambda name, rows: f"""
{name} as (select tree, 0 level, place, n, d from {rows}
  union all select tree, level + 1, place // 3, (n + 2) // 3, sha256(string_agg(d, '' order by place)) from {name} where n > 1 group by tree, level, place // 3, n),
{name}_p as (select x.tree, x.place, l.level, string_agg(s.d, '' order by s.place) filter (s.place < l.own) a, string_agg(s.d, '' order by s.place) filter (s.place > l.own) b
  from {rows} x, lateral (select level, x.place // cast(pow(3, level) as bigint) own from (select distinct level, n from {name} where tree = x.tree and n > 1)) l
  left join {name} s on s.tree = x.tree and s.level = l.level and s.place // 3 = l.own // 3 and s.place <> l.own group by x.tree, x.place, l.level, l.own),
{name}_t as (select tree, d from {name} where n = 1)"""  # noqa: E731
    return f"""
with recursive d as (select doc_id, case when source is null then 'a' else 'b' || source end tree, sha256({values}) leaf,
    case when ({crc}) % 2 = 0 then sha256({tampered}) end cut from documents),
l as (select *, leaf d, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 place, count(*) over (partition by tree) n from d),
{forest('f', 'l')},
r as (select '' tree, tree of, d, row_number() over (order by encode(tree)) - 1 place, count(*) over () n from f_t),
{forest('g', 'r')},
w as (select l.tree, l.place, 0 part, level, coalesce(a, '') a, coalesce(b, '') b from l join f_p using (tree, place)
  union all select l.tree, l.place, 1, level, coalesce(a, ''), coalesce(b, '') from l join r on r.of = l.tree join g_p on g_p.place = r.place),
p as (select tree, place, list(a || '|' || b order by part, level) steps, string_agg(a || b, '' order by part, level) proof from w group by all)
select doc_id, leaf, f_t.d subroot, g_t.d root, sha256(coalesce(proof, '')) proof_sha256,
  list_reduce(list_concat([coalesce(cut, leaf)], coalesce(steps, [])), lambda v, s: sha256(split_part(s, '|', 1) || v || split_part(s, '|', 2))) folded_root,
  folded_root = root verified
from l join f_t on f_t.tree = l.tree cross join g_t left join p on p.tree = l.tree and p.place = l.place"""
