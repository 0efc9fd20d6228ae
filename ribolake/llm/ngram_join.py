"""Jaccard join on word n-grams by group counts, with an R-tree of count vectors.

A document is the set of its hashed n-grams. Two sets link if their intersection is at
least ``share`` percent of their union.

*Classes.* Equal sets are one class from the start, so copies are never paired.

*Groups.* Tokens are hashed into groups whose number follows the size class: sets that
link differ in at most H tokens, so of H + 1 + x groups they agree in x + 1 or more. A
class emits a signature for each group's content, except for its x emptiest groups (all
groups up to one count, at most x of them); two linked classes still share one
signature. Only repeated signatures go on. A passage in many documents shares groups with
other words and hence hardly ever makes a signature of its own.

*Pivots.* Within a signature every class is verified against one pivot, the class that
shares most with others, so a group of copies costs links in proportion to its size.

*R-tree.* Where the pivots left the members of a signature in several components, the
members are points (token counts in fixed groups) in a packed R-tree, and those outside
the largest component query it. A page is skipped if the sum of the smaller coordinates
of the query and the page's upper corner is below the overlap that a link needs. What
the vectors alone may connect is a family; its members are searched once more and the
surviving pairs that are not yet connected verified on the whole sets. Large groups are
cut into chunks, and a chunk of queries and a chunk of the index are a task of their
own; small groups share a task up to the same size. So no task holds more than about two
chunks (a set is never cut, and chunks are dealt by hash).

Every bound is exact, no candidate is dropped or capped. Classes are told apart by 64
bits of hash over all tokens and the set size.

Defined results: a text without words, or null, has no tokens, links with nothing and is
its own component. A text with fewer words than n is one token. A component's id is its
smallest id that is not null. Rows equal in id and text are one document; repeated ids
with different texts are different documents. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import textbatch
from .common import discard, join_small, ship, stage, text_of
from .graph import components

SIZE_STEP = 1.35
CHUNK_TOKENS = 1 << 20
VECTOR_BITS = 8  # unrelated sets of up to some 6,000 tokens differ by more than a link allows
VECTOR = 1 << VECTOR_BITS
PAGE = 32
BUCKET_GROUPS = 10_000  # groups that are packed into tasks by one running sum
SIGNATURE_LIMIT = 2_000_000  # signatures of 8 bytes that may be broadcast


@lru_cache(maxsize=None)
def schemes(share: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smallest size of every size class, its number of groups (0: only equal sets link) and the spare groups."""
    lows = [1]
    while lows[-1] < 1 << 40:
        lows.append(int(lows[-1] * SIZE_STEP) + 1)
    low = np.array(lows, np.int64)
    apart = 2 * (low[1:] - 1) * (100 - share) // (100 + share)
    spare = apart // 2 + 2
    return low[:-1], np.where(apart > 0, apart + 1 + spare, 0), spare


def token_sets(texts: pa.Array, n: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per run of texts: first and end row, then text number and token, distinct and sorted."""
    for first, end, raw, offsets in textbatch.chunks(texts):
        yield (first, end, *textbatch.distinct(*textbatch.shingles(textbatch.Words(raw, offsets), n)))


def class_ids(rows: np.ndarray, tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(sizes), np.uint64)
    if len(rows):
        sums[sizes > 0] = np.add.reduceat(textbatch.mixed(tokens), np.flatnonzero(np.diff(rows, prepend=-1)))
    return textbatch.mixed(sums + sizes.astype(np.uint64)).view(np.int64)


def signatures(rows: np.ndarray, tokens: np.ndarray, sizes: np.ndarray, share: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and signature, for the size class of each text and those it can reach."""
    low, groups, spare = schemes(share)
    own = np.searchsorted(low, sizes, "right") - 1
    out_rows, out = [], []
    step = 0
    while True:
        scheme = own + step
        takes = (sizes > 0) & (100 * sizes >= share * low[np.minimum(scheme, len(low) - 1)])
        if not takes.any():
            break
        m = np.where(takes, groups[scheme], 0)
        use = m[rows] > 0
        r, t = rows[use], tokens[use]
        step += 1
        if not len(r):
            continue
        g = ((t >> np.uint64(32)) * m[r].astype(np.uint64)) >> np.uint64(32)
        start = np.flatnonzero((np.diff(r, prepend=-1) != 0) | (np.diff(g.view(np.int64), prepend=-1) != 0))
        count = np.diff(np.append(start, len(r)))
        row, group = r[start], g[start]
        name = textbatch.mixed((scheme[row].astype(np.uint64) << np.uint64(40)) + group)
        sig = textbatch.mixed(np.add.reduceat(textbatch.mixed(t ^ np.uint64(0x5DEECE66D)), start) + name)
        empty = m - np.bincount(row, minlength=len(sizes))
        drop = np.full(len(sizes), -1)
        for c in range(4):
            few = empty + np.bincount(row[count <= c], minlength=len(sizes))
            drop = np.where(few <= spare[np.minimum(scheme, len(spare) - 1)], c, drop)
        keep = count > drop[row]
        out_rows.append(row[keep])
        out.append(sig[keep])
        for i in np.flatnonzero((drop < 0) & (m > 0)):  # too many empty groups to leave them out
            none = np.setdiff1d(np.arange(m[i], dtype=np.uint64), group[row == i])
            out_rows.append(np.full(len(none), i))
            out.append(textbatch.mixed(textbatch.mixed((np.uint64(scheme[i]) << np.uint64(40)) + none)))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    all_rows, sigs = np.concatenate(out_rows), np.concatenate(out).view(np.int64)
    order = np.argsort(all_rows, kind="stable")
    return all_rows[order], sigs[order]


def classed(docs: DataFrame, n: int, share: int) -> DataFrame:
    """Id, text key, set size, class (null without tokens), counts and signatures of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, rows, tokens in token_sets(batch.column("text"), n):
                sizes = np.bincount(rows, minlength=end - first)
                vectors = count_vectors(rows, tokens, end - first)
                sig_rows, sigs = signatures(rows, tokens, sizes, share)
                ends = np.concatenate(([0], np.cumsum(np.bincount(sig_rows, minlength=end - first))))
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_key"), pa.array(sizes),
                     pa.array(class_ids(rows, tokens, sizes), mask=sizes == 0), vectors,
                     pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(sigs))],
                    names=["doc_id", "text_key", "n_shingles", "cls", "vector", "sigs"],
                )

    ship(docs.sparkSession)
    text = text_of(docs)
    return docs.select(
        docs["doc_id"].cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text")
    ).mapInArrow(run, "doc_id bigint, text_key bigint, n_shingles bigint, cls bigint, vector array<int>, sigs array<bigint>")


def count_vectors(rows: np.ndarray, tokens: np.ndarray, n: int) -> pa.ListArray:
    """Token counts of every text in ``VECTOR`` fixed groups."""
    group = (textbatch.mixed(tokens) >> np.uint64(64 - VECTOR_BITS)).astype(np.int64)
    counts = np.bincount(rows * VECTOR + group, minlength=n * VECTOR).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * VECTOR), pa.array(counts))


def sets_of(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """Sorted tokens and count vector of every wanted class, from one document of each.

    ``wanted(cls, rep_id, rep_key)``, a written table, names that document. Written.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, rows, tokens in token_sets(batch.column("text"), n):
                sizes = np.bincount(rows, minlength=end - first)
                ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(class_ids(rows, tokens, sizes)), pa.array(sizes),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(tokens.view(np.int64))),
                     count_vectors(rows, tokens, end - first)],
                    names=["cls", "n", "tokens", "vector"],
                )

    text = text_of(docs)
    keyed = docs.select(
        F.coalesce(docs["doc_id"].cast("bigint"), F.lit(-1 << 63)).alias("rep_id"), F.xxhash64(text).alias("rep_key"),
        text.alias("text"),
    )
    ids = wanted.select(F.coalesce("rep_id", F.lit(-1 << 63)).alias("rep_id"), "rep_key")
    found = join_small(keyed, ids, ["rep_id", "rep_key"], wanted.count(), 16, limit=SIGNATURE_LIMIT).select("text")
    sets = stage(found.mapInArrow(run, "cls bigint, n bigint, tokens array<bigint>, vector array<int>"), "join-sets")
    # Only repeated rows give a class twice.
    rows, classes = sets.agg(F.count("*"), F.count_distinct("cls")).first()
    return sets if rows == classes else stage(sets.dropDuplicates(["cls"]), "join-sets")


def sides(pairs: DataFrame, content: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` with the columns of both classes, prefixed."""
    side = lambda x: content.select(*[F.col(c).alias(f"{x}_{c}" if c != "cls" else x) for c in content.columns])
    return pairs.join(side("a"), "a").join(side("b"), "b")


def enough(common: Column, share: int) -> Column:
    return (100 + share) * common >= share * (F.col("a_n") + F.col("b_n"))


def possible(pairs: DataFrame, classes: DataFrame, share: int) -> DataFrame:
    """The pairs whose summed coordinate minima allow a link."""
    bound = F.aggregate(
        F.zip_with("a_vector", "b_vector", lambda x, y: F.least(x, y)), F.lit(0), lambda total, x: total + x
    )
    return sides(pairs, classes.select("cls", "n", "vector")).filter(enough(bound, share)).select("a", "b")


def verified(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """The pairs that link."""
    both = sides(pairs, sets.select("cls", "n", "tokens"))
    return both.filter(enough(F.size(F.array_intersect("a_tokens", "b_tokens")), share)).select("a", "b")


def pages_of(vectors: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A packed R-tree of one level: order of points, page starts, upper corners, least sizes.

    Points are tiled by size, then by their most varied coordinates.
    """
    tiles = max(int(np.ceil((len(sizes) / PAGE) ** (1 / 3))), 1)
    axes = np.argsort(-vectors.var(axis=0))[:2]
    order = np.argsort(sizes, kind="stable")
    for axis in axes:
        cut = np.array_split(order, tiles)
        order = np.concatenate([part[np.argsort(vectors[part, axis], kind="stable")] for part in cut])
        tiles *= tiles
    starts = np.arange(0, len(order), PAGE)
    return order, starts, np.maximum.reduceat(vectors[order], starts), np.minimum.reduceat(sizes[order], starts)


def search_pages(query: np.ndarray, size: int, tree, vectors: np.ndarray, sizes: np.ndarray, share: int) -> np.ndarray:
    """Points whose summed coordinate minima with ``query`` allow a link."""
    order, starts, corners, least = tree
    able = (100 + share) * np.minimum(corners, query).sum(axis=1) >= share * (size + least)
    points = np.concatenate([order[s : s + PAGE] for s in starts[able]] or [order[:0]])
    common = np.minimum(vectors[points], query).sum(axis=1)
    return points[(100 + share) * common >= share * (size + sizes[points])]


def linked_in(index: pd.DataFrame, queries: pd.DataFrame, share: int, exact: bool) -> list[tuple[int, int]]:
    """Pairs of ``queries`` and members of ``index`` that connect two components.

    With ``exact`` the pairs link; without, their vectors allow a link and the rows need
    no tokens. A pair that connects nothing new is left out.
    """
    sizes, vectors = index["n"].to_numpy(np.int64), np.stack(index["vector"].tolist()).astype(np.int32)
    names = index["cls"].to_numpy(np.int64)
    unsigned = lambda column: [np.asarray(x, np.int64).view(np.uint64) for x in column]  # sorted as such
    tokens, asked = (unsigned(index["tokens"]), unsigned(queries["tokens"])) if exact else ([], [None] * len(queries))
    _, roots = np.unique(np.concatenate([index["root"], queries["root"]]).astype(np.int64), return_inverse=True)
    root, query_root = roots[: len(index)], roots[len(index) :]
    tree = pages_of(vectors, sizes)
    links = []
    for i, (name, own, size, vector) in enumerate(zip(queries["cls"], asked, queries["n"], queries["vector"])):
        points = search_pages(np.asarray(vector), size, tree, vectors, sizes, share)
        points = points[root[points] != query_root[i]]
        if exact and len(points):
            run = np.concatenate([tokens[p] for p in points])
            begin = np.concatenate(([0], np.cumsum(sizes[points])[:-1]))
            hit = own[np.minimum(np.searchsorted(own, run), size - 1)] == run
            common = np.add.reduceat(hit.astype(np.int64), begin)
            points = points[(100 + share) * common >= share * (size + sizes[points])]
        for p in points:
            if root[p] != query_root[i]:
                links.append((name, names[p]))
                old = query_root[i]
                root[root == old] = root[p]
                query_root[query_root == old] = root[p]
    return links


def packed_groups(groups: DataFrame) -> DataFrame:
    """Add ``bucket`` and ``pack`` to ``groups(group, chunks, query_chunks, work)``. Written.

    Groups whose index and queries weigh at most a chunk are dealt to buckets, and a
    bucket is cut by its running weight: a pack weighs less than two chunks. Every other
    group is a pack of its own, further cut by its chunks.
    """
    groups = stage(groups, "join-groups")
    buckets = groups.count() // BUCKET_GROUPS + 1
    small = F.col("work") <= CHUNK_TOKENS
    before = Window.partitionBy("bucket").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    packed = groups.filter(small).withColumn("bucket", F.pmod(F.xxhash64("group"), F.lit(buckets)).cast("int")).withColumn(
        "pack", F.floor(F.coalesce(F.sum("work").over(before), F.lit(0)) / CHUNK_TOKENS)
    )
    alone = groups.filter(~small).select("*", F.lit(-1).alias("bucket"), F.col("group").alias("pack"))
    return stage(packed.union(alone), "join-open")


def between_roots(members: DataFrame, sets: DataFrame, share: int, exact: bool) -> DataFrame:
    """Pairs that connect different roots inside each group of ``members(group, cls, root)``.

    The members outside the group's largest component are the queries, all members the
    index; both are cut into chunks of bounded size, and every chunk of queries meets
    every chunk of the index.

    A signature of two members has its only pair verified with the pivot. A family of two
    classes has not: they may come from signatures whose pivot is a third class.
    """
    weight = F.col("n") if exact else F.lit(VECTOR)
    known = stage(members.join(sets.select("cls", "n"), "cls").select("group", "cls", "root", weight.alias("weight")), "join-known")
    parts = known.groupBy("group", "root").agg(
        F.count("*").alias("size"), F.sum("weight").alias("total"), F.bit_xor(F.xxhash64("cls")).alias("list")
    )
    lists = parts.groupBy("group").agg(
        F.max(F.struct("size", "total", "root")).alias("main"), F.sum("total").alias("total"), F.sum("size").alias("size"),
        F.bit_xor("list").alias("list"),
    ).filter("size > main.size" if exact else "size > 2 and size > main.size")
    chunks = lambda amount: F.ceil(amount / CHUNK_TOKENS).cast("int")
    # Groups with the same members are searched once.
    open_ = packed_groups(
        lists.groupBy("size", "list").agg(F.min(F.struct("group", "main", "total")).alias("g")).select(
            "g.group", F.col("g.main.root").alias("main"), chunks(F.col("g.total")).alias("chunks"),
            chunks(F.col("g.total") - F.col("g.main.total")).alias("query_chunks"),
            (2 * F.col("g.total") - F.col("g.main.total")).alias("work"),
        )
    )
    count = open_.count()
    schema = "a bigint, b bigint"
    if not count:
        return members.sparkSession.createDataFrame([], schema)
    rows = join_small(known.drop("weight"), open_, ["group"], count, 48)
    place = lambda salt, n: F.pmod(F.xxhash64("cls", F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    index = rows.select("group", "bucket", "pack", "cls", "root", F.lit(False).alias("query"), place(1, "chunks").alias("i"), every("query_chunks").alias("j"))
    queries = rows.filter("root <> main").select(
        "group", "bucket", "pack", "cls", "root", F.lit(True).alias("query"), every("chunks").alias("i"), place(2, "query_chunks").alias("j")
    )
    content = sets if exact else sets.select("cls", "n", "vector")
    keyed = index.union(queries).join(content, "cls")

    def run(part: pd.DataFrame) -> pd.DataFrame:
        links = []
        for _, group in part.groupby(["group", "i", "j"], sort=False):
            asked = group["query"].to_numpy(bool)
            if asked.any() and not asked.all():
                links += linked_in(group[~asked], group[asked], share, exact)
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    return keyed.groupBy("bucket", "pack", "i", "j").applyInPandas(run, schema)


def residual_links(docs: DataFrame, members: DataFrame, roots: DataFrame, classes: DataFrame, n: int, share: int) -> DataFrame:
    """Links inside signatures whose members the pivots left in several components.

    The vectors of each signature's members come first: what they may connect is a
    family. Then the members of each family are searched again, with their tokens.
    """
    rooted = lambda df: df.join(roots, df["cls"] == roots["node"], "left").drop("node").withColumn(
        "root", F.coalesce("root", "cls")
    )
    groups = rooted(members.select(F.col("sig").alias("group"), "cls"))
    likely = stage(between_roots(groups, classes.select("cls", "n", "vector"), share, False), "join-likely")
    if not likely.limit(1).count():
        return likely
    known = roots.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    families = components(likely.union(known)).select(F.col("root").alias("group"), F.col("node").alias("cls"))
    # Families that are one component already need no second look.
    groups = stage(rooted(families), "join-families")
    mixed = stage(
        groups.groupBy("group").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("group"),
        "join-mixed",
    )
    groups = stage(join_small(groups, mixed, ["group"], mixed.count(), 16), "join-families")
    wanted = stage(classes.join(groups.select("cls"), "cls", "left_semi").select("cls", "rep_id", "rep_key"), "join-wanted")
    return between_roots(groups, sets_of(docs, wanted, n), share, True)


def joined(docs: DataFrame, n: int = 5, share: int = 80) -> DataFrame:
    """Id, text key, set size and component of every document; a written table.

    ``component_key`` is the text key of the component's first document: the one of the
    smallest id, null last, and of the smallest key among rows of that id.
    """
    rows = stage(classed(docs, n, share), "join-rows")
    narrow = stage(rows.select("doc_id", "text_key", "n_shingles", "cls"), "join-narrow")
    classes = stage(
        rows.filter("cls is not null").groupBy("cls").agg(
            F.first("n_shingles").alias("n"), F.first("vector").alias("vector"), F.min("doc_id").alias("rep_id"),
            F.min_by("text_key", F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("rep_key"),
        ), "join-classes",
    )
    emitted = rows.select("cls", F.explode("sigs").alias("sig"))
    repeated = stage(
        emitted.groupBy("sig").agg(F.min("cls").alias("low"), F.max("cls").alias("high")).filter("low < high").select("sig"),
        "join-signatures",
    )
    members = stage(
        join_small(emitted, repeated, ["sig"], repeated.count(), 16, limit=SIGNATURE_LIMIT).distinct(), "join-members"
    )
    discard(rows)  # what is still needed of it is written
    sizes = members.groupBy("sig").agg(F.count("*").alias("size"))
    ties = stage(members.join(sizes, "sig").groupBy("cls").agg(F.sum("size").alias("ties")), "join-ties")
    pivots = members.join(ties, "cls").groupBy("sig").agg(F.max(F.struct("ties", "cls")).alias("pivot"))
    pairs = members.join(pivots.select("sig", F.col("pivot.cls").alias("pivot")), "sig").filter("cls <> pivot").select(
        F.col("pivot").alias("a"), F.col("cls").alias("b")
    ).distinct()
    pairs = stage(possible(pairs, classes, share), "join-pairs")
    ends = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    wanted = stage(classes.join(ends, "cls", "left_semi").select("cls", "rep_id", "rep_key"), "join-wanted")
    links = stage(verified(pairs, sets_of(docs, wanted, n), share), "join-links")
    roots = stage(components(links), "join-roots")
    more = stage(residual_links(docs, members, roots, classes, n, share), "join-more")
    if more.limit(1).count():
        bridges = more.select("a", "b").union(roots.filter("node <> root").select("node", "root"))
        roots = stage(components(bridges), "join-roots")
    named = classes.select("cls", "rep_id", "rep_key").join(roots, classes["cls"] == roots["node"], "left").select(
        "cls", "rep_id", "rep_key", F.coalesce("root", "cls").alias("root")
    )
    least = named.groupBy("root").agg(F.min(F.struct(F.col("rep_id").isNull().alias("none"), "rep_id", "rep_key")).alias("first"))
    ids = named.join(least, "root").select("cls", F.col("first.rep_id").alias("component_id"), F.col("first.rep_key").alias("component_key"))
    return stage(
        narrow.join(ids, "cls", "left").select(
            "doc_id", "text_key", "n_shingles", "cls",
            F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
            F.coalesce("component_key", "text_key").alias("component_key"),
        ), "join-components",
    )


def one_of_each(docs: DataFrame, n: int = 5, share: int = 80) -> DataFrame:
    """The documents without near copies: of each component the one with the smallest id.

    A null id comes last, and rows of one id are ordered by their text keys. Documents without words all stay. Rows equal in id and text stay once.
    """
    found = joined(docs, n, share)
    lost = stage(
        found.filter("not (doc_id <=> component_id and text_key = component_key)").select(
            F.coalesce("doc_id", F.lit(-1 << 63)).alias("_join_id"), F.col("text_key").alias("_join_key")
        ).distinct(), "join-lost",
    )
    again = stage(
        found.filter("cls is not null and doc_id <=> component_id and text_key = component_key").groupBy(
            F.coalesce("doc_id", F.lit(-1 << 63)).alias("_join_id"), F.col("text_key").alias("_join_key")
        ).count().filter("count > 1").select("_join_id", "_join_key"), "join-again",
    )
    on = ["_join_id", "_join_key"]
    keyed = docs.withColumn("_join_id", F.coalesce(docs["doc_id"].cast("bigint"), F.lit(-1 << 63))).withColumn(
        "_join_key", F.xxhash64(text_of(docs))
    )
    kept = join_small(keyed, lost, on, lost.count(), 16, "left_anti", SIGNATURE_LIMIT)
    n_again = again.count()
    if n_again:
        twice = join_small(kept, again, on, n_again, 16, "left_semi").dropDuplicates(on)
        kept = join_small(kept, again, on, n_again, 16, "left_anti").unionByName(twice)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def oracle_sql(n: int, share: int) -> str:
    """The same by counting shared tokens of all pairs and following links; for small tables."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
    with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') w from documents),
    s as (select distinct doc_id, array_to_string(w[i:i + {n - 1}], ' ') g from (select doc_id, w, unnest(range(1, greatest(len(w) - {n - 1}, 1) + 1)) i from w where len(w) > 0)),
    c as (select doc_id, count(*) n from s group by doc_id),
    p as (select a.doc_id a, b.doc_id b, count(*) k from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
    l as (select a, b from p join c x on x.doc_id = a join c y on y.doc_id = b where 100 * k >= {share} * (x.n + y.n - k)),
    e as (select a, b from l union all select b, a from l),
    r(doc_id, o) as (select doc_id, doc_id from documents union select r.doc_id, e.b from r join e on e.a = r.o)
    select r.doc_id, coalesce(max(c.n), 0) n_shingles, min(o) component_id from r left join c on c.doc_id = r.doc_id group by r.doc_id"""
