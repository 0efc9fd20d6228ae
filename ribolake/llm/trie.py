"""Prefix trie of conversations with subtree totals by depth bands.

A node is a distinct sequence of first turns. Its key is a checksum of the sums, over
these turns, of checksums salted with the turn's depth; sums over prefixes are running
sums, so the key of every prefix of a conversation of any length comes from sums per block
of turns and offsets of the blocks. No text is shuffled except to sort the turns.

Totals over subtrees are rolled up in bands of ``HEIGHT`` depths. A node's value is given
to its ancestors inside its band only. The totals of the nodes that begin a band then form
a trie of their own, ``HEIGHT`` times lower, which is rolled up the same way; on the way
back the completed total of each band's first node is given to the ancestors in the band
before. So a value is copied at most ``HEIGHT`` times a level, and the number of levels is
the logarithm of the greatest depth to the base ``HEIGHT``. All sums combine map-side, so
the root, above every node, is one row a task.

The conversations that end at a node are joined into its checksum in two steps: runs of
ids are written as text by the tasks of a sort over nodes and ids, and one task a node
hashes these runs one after the other. A checksum of a list has to be computed in order;
that task holds one run at a time.

Defined results: a null role or text is empty. Turns are ordered by number, null first;
equal numbers by role, then text; equal turns are all kept. Rows without a conversation
id belong to no conversation. A table without conversations has no root and no rows. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import count_words, ship, stage
from .ordering import sorted_rows, starts, with_places

HEIGHT = 16
BLOCK = 256  # turns of one conversation whose running sums one task computes
RUN_IDS = 4096
LONGEST_HEAD = 4
SUMS = ("s0", "s1", "s2", "s3")


def head_length(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its twenty: its checksum modulo 4."""
    return F.crc32(conv_id.cast("string").cast("binary")) % LONGEST_HEAD


def rebuilt(conversations: DataFrame, head=head_length, group: int = 20) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, depth from 1, digest, words, length) and all conversations (conv_id, length), written.

    Conversation c gets the first ``head(c)`` turns of conversation c - c % ``group``, then
    its own turns after its first ``head(c)``.
    """
    role, text = (F.coalesce(conversations[c].cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.select(
        conversations["conv_id"].cast("bigint").alias("conv_id"), conversations["turn"].alias("turn"),
        role.alias("role"), text.alias("text"),
    ).filter("conv_id is not null")
    placed = sorted_rows(
        turns.withColumn("digest", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
        .withColumn("words", count_words(F.col("text"))),
        "conv_id", ["turn", "role", "text"], ["conv_id", "digest", "words"], "trie-turns",
    )
    first = starts(placed, "conv_id", "trie-starts")
    own = first.filter("_before = 0").select(
        "conv_id", "n", head(F.col("conv_id")).alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base")
    )
    lengths = own.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = stage(
        own.join(lengths, "base", "left").withColumn("used", F.least("h", F.coalesce("base_n", F.lit(0))))
        .withColumn("length", F.col("used") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
        .select("conv_id", "base", "h", "used", "length"), "trie-conversations",
    )
    # What a conversation's rows need is joined to the counts of its tasks, not to its turns.
    every = with_places(placed, first.drop("n").join(convs.drop("base"), "conv_id"), "conv_id")
    every = stage(every, "trie-places")
    kept = every.filter(F.col("at") >= F.col("h")).withColumn("depth", F.col("at") - F.col("h") + F.col("used") + 1)
    heads = every.filter(F.col("at") < LONGEST_HEAD - 1).select(F.col("conv_id").alias("base"), "at", "digest", "words")
    taken = convs.filter("used > 0").join(heads, "base").filter(F.col("at") < F.col("used")).withColumn("depth", F.col("at") + 1)
    columns = ["conv_id", "depth", "digest", "words", "length"]
    return kept.select(*columns).unionByName(taken.select(*columns)), convs.select("conv_id", "length")


def _key(depth: Column, sums: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(",", depth.cast("string"), *[s.cast("string") for s in sums])))


def paths(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per conversation and depth from 0, written: key, parent's key, words, whether it ends there."""
    salted = F.md5(F.concat(F.col("depth").cast("string"), F.lit(":"), "digest"))
    parts = [F.conv(F.substring("_salted", 8 * i + 1, 8), 16, 10).cast("bigint").alias(s) for i, s in enumerate(SUMS)]
    rows = stage(
        turns.withColumn("_salted", salted).select(
            "conv_id", "depth", "words", (F.col("depth") == F.col("length")).alias("ends"),
            F.floor(F.col("depth") / BLOCK).alias("block"), *parts,
        ), "trie-sums",
    )
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("conv_id", "block").agg(*[F.sum(s).alias(s) for s in SUMS]).select(
        "conv_id", "block", *[F.sum(s).over(before).alias(f"{s}_before") for s in SUMS]
    ).filter("block > 0")
    running = Window.partitionBy("conv_id", "block").orderBy("depth")
    summed = rows.join(offsets, ["conv_id", "block"], "left").withColumns({
        f"{s}_all": F.sum(s).over(running) + F.coalesce(f"{s}_before", F.lit(0)) for s in SUMS
    })
    nodes = summed.select(
        "conv_id", "depth", "words", "ends", _key(F.col("depth"), [F.col(f"{s}_all") for s in SUMS]).alias("key"),
        _key(F.col("depth") - 1, [F.col(f"{s}_all") - F.col(s) for s in SUMS]).alias("parent"),
    )
    zero = F.lit(0).cast("bigint")
    roots = convs.select(
        "conv_id", zero.alias("depth"), zero.alias("words"), (F.col("length") == 0).alias("ends"),
        _key(zero, [zero] * len(SUMS)).alias("key"), F.lit(None).cast("binary").alias("parent"),
    )
    return stage(nodes.unionByName(roots), "trie-paths")


def subtree_totals(nodes: DataFrame, path: DataFrame, values: list[str], height: int = HEIGHT) -> DataFrame:
    """``key`` and the sums of ``values`` over its subtree, by bands of ``height`` depths.

    ``nodes`` has key, depth, conv_id (any member) and the values, ``path`` the keys of all
    conversations by depth; both are written tables.
    """
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    sums = [F.sum(v).alias(v) for v in values]
    unit, own, levels = 1, nodes.select("key", "depth", "conv_id", *values), []
    while True:
        band = F.floor(F.col("depth") / (unit * height))
        keys = path.filter(F.col("depth") % unit == 0).groupBy("conv_id", band.alias("band")).agg(
            F.array_sort(F.collect_list(F.struct("depth", "key"))).alias("keys")  # at most ``height`` entries
        ).select("conv_id", "band", F.col("keys.key").alias("keys"))
        keys = keys if deepest < unit * height else stage(keys, "trie-bands")
        inside = (F.floor(F.col("depth") / unit) % height + 1).cast("int")
        given = own.filter(" or ".join(f"{v} <> 0" for v in values)).withColumn("band", band).join(keys, ["conv_id", "band"]).select(
            F.explode(F.slice("keys", F.lit(1), inside)).alias("key"), *values
        )
        totals = given.groupBy("key").agg(*sums)
        if deepest < unit * height:
            break
        totals = stage(totals, "trie-totals")
        levels.append((totals, keys, unit * height))
        unit *= height
        own = stage(nodes.filter(F.col("depth") % unit == 0).select("key", "depth", "conv_id").join(totals, "key"), "trie-band-roots")
    # Back down: the first node of every band but the top one is complete now.
    for partial, keys, step in reversed(levels):
        whole = stage(totals, "trie-whole")
        tops = nodes.filter((F.col("depth") % step == 0) & (F.col("depth") > 0)).select("key", "depth", "conv_id").join(whole, "key")
        passed = tops.withColumn("band", F.floor(F.col("depth") / step) - 1).join(keys, ["conv_id", "band"]).select(
            F.explode("keys").alias("key"), *values
        )
        totals = partial.unionByName(passed).groupBy("key").agg(*sums)
    return totals


def ends_checksums(ends: DataFrame) -> DataFrame:
    """``key`` and the SHA-256 of the ascending, comma-joined ids of ``ends(key, conv_id)``."""
    ship(ends.sparkSession)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, ids = None, None, []
        for batch in batches:
            out = []
            for k, c in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
                if k != key or len(ids) == RUN_IDS:
                    if ids:
                        out.append((key, first, ",".join(ids)))
                    key, first, ids = k, c, []
                ids.append(str(c))
            yield _runs_batch(out)
        if ids:
            yield _runs_batch([(key, first, ",".join(ids))])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for k, text in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if k != key:
                    if key is not None:
                        out.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield _hash_batch(out)
        if key is not None:
            yield _hash_batch([(key, state.hexdigest())])

    written = stage(ends.orderBy("key", "conv_id").mapInArrow(runs, "key binary, first bigint, ids string"), "trie-ends")
    return written.repartition("key").sortWithinPartitions("key", "first").select("key", "ids").mapInArrow(
        hashed, "key binary, ends_sha256 string"
    )


def _runs_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string())],
        names=["key", "first", "ids"],
    )


def _hash_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], names=["key", "ends_sha256"]
    )


def trie(conversations: DataFrame, head=head_length, group: int = 20, height: int = HEIGHT) -> DataFrame:
    """One row per node: members, parent, children, and totals of its subtree."""
    path = paths(*rebuilt(conversations, head, group))
    grouped = path.groupBy("key", "parent", "depth", "words").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    bare = stage(grouped, "trie-nodes")
    children = bare.filter("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    nodes = stage(
        bare.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
        .withColumn("n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint"))
        .withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("words")), "trie-counted",
    )
    totals = subtree_totals(nodes, path, ["n_leaves", "saved_tokens"], height)
    ends = ends_checksums(path.filter("ends").select("key", "conv_id"))
    parents = bare.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.drop("n_leaves", "saved_tokens").join(totals, "key", "left").join(ends, "key", "left").join(parents, "parent", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
            F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )


# Unsigned CRC-32 of a short ASCII text, bit by bit.
CRC_SQL = """(xor(4294967295, list_reduce(list_concat([4294967295::bigint], list_transform(range(1, len({0}) + 1), lambda i: ascii({0}[i])::bigint)),
  lambda c, b: list_reduce(list_concat([xor(c, b)], [0::bigint for z in range(8)]), lambda v, z: xor(v >> 1, (v & 1) * 3988292384)))))"""


def oracle_sql() -> str:
    crc = CRC_SQL.format("cast(conv_id as varchar)")
    return rf"""
with t as (select conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) p,
             coalesce(role, '') role, coalesce(text, '') txt from conversations where conv_id is not null),
c0 as (select distinct conv_id from t),
c as (select conv_id, conv_id - conv_id % 20 base, {crc} % 4 h from c0),
r0 as (select c.conv_id, 0 part, t.p, role, txt from c join t on t.conv_id = c.base and t.p <= c.h
       union all select c.conv_id, 1, t.p, role, txt from c join t on t.conv_id = c.conv_id and t.p > c.h),
r as (select conv_id, row_number() over (partition by conv_id order by part, p) depth, role, txt, count(*) over (partition by conv_id) len from r0),
p as (select conv_id, depth, depth = len ends, len(regexp_extract_all(txt, '[^\x20\x09-\x0D]+')) words,
        string_agg(len(role) || ':' || role || len(txt) || ':' || txt, '') over (partition by conv_id order by depth) k from r
      union all select conv_id, 0, not exists (select 1 from r where r.conv_id = c.conv_id), 0, '' from c),
n as (select k, depth, words, min(conv_id) conv_id, count(*) n_convs,
        sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (ends), '')) ends_sha256 from p group by all),
e as (select n.*, q.k pk from n left join p q on q.conv_id = n.conv_id and q.depth = n.depth - 1),
ch as (select pk k, count(*) m from e where pk is not null group by pk),
f as (select e.*, coalesce(m, 0) n_children from e left join ch on e.k = ch.k),
s as (select a.k, count(*) filter (f.n_children = 0) n_leaves, sum((f.n_convs - 1) * f.words) saved
      from f join p a on a.conv_id = f.conv_id and a.depth <= f.depth group by a.k)
select f.conv_id, cast(f.depth as bigint) depth, g.conv_id parent_conv_id, f.n_convs, f.n_children, s.n_leaves, cast(s.saved as bigint) saved_tokens, f.ends_sha256
from f join s on f.k = s.k left join n g on g.k = f.pk"""
