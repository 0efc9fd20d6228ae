"""Removal of benchmark passages: a broadcast hash set of word windows, scanned and verified.

Texts are compared by their words: runs of digits, ASCII letters in lower case and longer
code points. Every window of ``WINDOW`` words of a benchmark item is in the set; an item
with fewer words is one window. The windows of a document are hashed inside its row and
looked up in the set; what is found is verified against the window's own words before it
counts. The words that verified windows cover are hits.

The set is cut by hash into blocks that are counted and broadcast one by one, a scan of
the documents for each, so no broadcast exceeds ``BLOCK_WINDOWS`` rows; a set within the
bound is one scan. Only found windows are shuffled. Windows stand in for their items by
the set of items that have them, so a window that many items share is not multiplied by
them, and equal combinations of such sets are unfolded once.

Defined results: a null text has no words, a document without words no hits. An item
without words has no window; an item without id marks words but is not counted or named.
Items that share an id are one item. Repeated rows are judged alike, a null document id is
kept. Other columns are passed on by the filters and not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import bound, stage, text_of

WINDOW = 10
BLOCK_WINDOWS = 400_000
MARKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same in a text that still has its upper case.
RAW_MARKS = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normal_words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), MARKS), "")


def window_hashes(words: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words, by their place."""
    return F.when(F.size(words) < size, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(words) - (size - 1)), lambda i: F.xxhash64(F.slice(words, i, F.lit(size))))
    )


def text_key(text: Column) -> Column:
    """What stands for a text beside its id when rows are joined again."""
    return F.md5(text)


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (hash, size, words, items) and sets of items (items, ids), both written."""
    words = normal_words(text_of(benchmark))
    cut = lambda ws: F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(ws) - (window - 1), F.lit(1))), lambda i: F.slice(ws, i, F.lit(window))
    )
    runs = benchmark.select(
        benchmark["item_id"].cast("string").alias("item"),
        F.explode_outer(bound(words, lambda ws: F.when(F.size(ws) > 0, cut(ws)))).alias("run"),
    ).filter("run is not null").withColumn("size", F.size("run"))
    # The benchmark is the small side: a window lists the items that have it.
    listed = runs.groupBy("run", "size").agg(F.array_sort(F.collect_set("item")).alias("ids"))
    every = stage(listed.withColumn("items", F.md5(F.array_join("ids", ","))), "leak-windows")
    windows = every.select(F.xxhash64("run").alias("hash"), "size", F.col("run").alias("window"), "items")
    return windows, stage(every.select("items", "ids").distinct(), "leak-items")


def scanned(docs: DataFrame, windows: DataFrame, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Verified finds, written: document, text key, place and size in words, set of items."""
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # at most the window size many
    total = windows.count()
    blocks = max(1, -(-total * 5 // (block_windows * 4))) if total > block_windows else 1
    if not sizes:
        sizes = [WINDOW]
    texts = docs.select(docs["doc_id"].alias("doc_id"), text_of(docs).alias("text"))
    # Words and hashes are one value, so that no pushed filter splits the text again.
    both = lambda ws: F.struct(ws.alias("words"), F.concat(*[window_hashes(ws, s) for s in sizes]).alias("hashes"))
    hashed = texts.withColumn("_w", bound(normal_words(F.col("text")), both)).select("doc_id", "text", "_w.words", "_w.hashes")
    # The lists of all sizes stand one behind the other; a find's size says which list it is in.
    skipped = F.lit(0)
    before = skipped
    for s in sizes:
        before = F.when(F.col("size") == s, skipped).otherwise(before)
        skipped = skipped + F.greatest(F.size("words") - (s - 1), F.lit(0))
    found = None
    for block in range(blocks):
        part = windows if blocks == 1 else windows.filter(F.pmod("hash", F.lit(blocks)) == block)
        if blocks > 1 and part.count() > block_windows:
            raise ValueError("a block of windows is above the bound of the broadcast")
        # The outer form infers no filter on the hashes, which would compute them twice; its null rows find nothing.
        rows = hashed.select("doc_id", "text", "words", F.posexplode_outer("hashes").alias("place", "hash")).join(F.broadcast(part), "hash")
        at = (F.col("place") - before).cast("int")
        rows = rows.withColumn("at", at).filter(
            (F.col("at") >= 0) & (F.slice("words", F.greatest(F.col("at"), F.lit(0)) + 1, F.col("size")) == F.col("window"))
        ).select("doc_id", text_key(F.col("text")).alias("text_key"), "at", "size", "items")
        found = rows if found is None else found.unionByName(rows)
    return stage(found, "leak-found")


def covered(spans: Column) -> Column:
    """Words inside any of the sorted spans (at, size), each counted once."""
    return F.aggregate(
        spans, F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("total")),
        lambda s, e: F.struct(
            F.greatest(s["end"], e["at"] + e["size"]).alias("end"),
            (s["total"] + F.greatest(e["at"] + e["size"] - F.greatest(e["at"], s["end"]), F.lit(0))).alias("total"),
        ),
        lambda s: s["total"],
    )


def findings(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Per document and text with hits, written: spans, words hit, number and checksum of items."""
    windows, sets = item_windows(benchmark, window)
    found = scanned(docs, windows, block_windows)
    # Sets of one text's own finds: its words bound them, however often the text occurs.
    per_text = stage(
        found.groupBy("doc_id", "text_key").agg(
            F.array_sort(F.collect_set(F.struct("at", "size"))).alias("spans"), F.array_sort(F.collect_set("items")).alias("sets")
        ).withColumn("mix", F.md5(F.array_join("sets", ","))), "leak-texts",
    )
    mixes = per_text.select("mix", "sets").distinct().select("mix", F.explode("sets").alias("items"))
    named = mixes.join(sets, "items").select("mix", F.explode_outer("ids").alias("item")).groupBy("mix").agg(
        F.array_sort(F.collect_set("item")).alias("ids")
    ).select("mix", F.size("ids").cast("bigint").alias("n_items"), F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"))
    return stage(
        per_text.withColumn("n_hit", covered(F.col("spans"))).join(named, "mix").select(
            F.col("doc_id").alias("_leak_id"), F.col("text_key").alias("_leak_key"), "spans", "n_hit", "n_items", "items_sha256"
        ), "leak-findings",
    )


def judged(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Every document with its words, hits and items."""
    hits = findings(docs, benchmark, window, block_windows)
    counted = docs.select(
        docs["doc_id"].alias("doc_id"), text_key(text_of(docs)).alias("_key"),
        F.size(normal_words(text_of(docs))).cast("bigint").alias("n_words"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("_leak_id")) & (F.col("_key") == F.col("_leak_key"))
    return counted.join(hits.drop("spans"), same, "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"),
    )


def without_spans(text: Column, spans: Column) -> Column:
    """The text less the words of the spans (at, size) and the marks between them."""
    pieces = F.regexp_extract_all(text, F.lit(f"[^{RAW_MARKS}]+|[{RAW_MARKS}]+"), F.lit(0))
    first_is_word = F.when(text.rlike(f"^[^{RAW_MARKS}]"), 0).otherwise(1)
    # A piece is a word or the marks behind a word; both have a number among the words.
    hit = lambda place: F.exists(spans, lambda e: (place >= e["at"]) & (place < e["at"] + e["size"]))

    def kept(piece: Column, i: Column) -> Column:
        word = F.floor((i - first_is_word) / 2).cast("int")
        is_word = (i - first_is_word) % 2 == 0
        return F.when(is_word & ~hit(word), piece).when(~is_word & ~(hit(word) & hit(word + 1)), piece).otherwise("")

    return bound(pieces, lambda all_: F.array_join(F.transform(all_, kept), ""))


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, remove: str = "spans", max_share: float = 0.5, window: int = WINDOW,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """The documents without benchmark passages, with their own columns.

    ``remove`` is ``documents`` (all with a hit go) or ``spans`` (the hit words are cut out,
    and documents with more than ``max_share`` of their words hit go).
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"unknown removal: {remove}")
    hits = findings(docs, benchmark, window, block_windows).select(
        "_leak_id", "_leak_key", F.col("spans").alias("_leak_spans"), F.col("n_hit").alias("_leak_n")
    )
    same = docs["doc_id"].eqNullSafe(F.col("_leak_id")) & (text_key(text_of(docs)) == F.col("_leak_key"))
    if remove == "documents":
        return docs.join(hits, same, "left_anti")
    joined = docs.join(hits, same, "left")
    share = F.col("_leak_n") / F.size(normal_words(text_of(docs)))
    clean = F.when(F.col("_leak_n").isNull(), docs["text"]).otherwise(without_spans(text_of(docs), F.col("_leak_spans")))
    return joined.filter(F.col("_leak_n").isNull() | (share <= max_share)).select(
        *[clean.alias(c) if c == "text" else docs[c] for c in docs.columns]
    )


def oracle_sql() -> str:
    low = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    words = rf"regexp_extract_all({low}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return rf"""
with b as (select cast(item_id as varchar) item, {words} ws from benchmark),
bw as (select distinct item, least(len(ws), {WINDOW}) z, array_to_string(ws[i + 1 : i + least(len(ws), {WINDOW})], ' ') w
  from (select *, unnest(range(0, len(ws) - least(len(ws), {WINDOW}) + 1)) i from b where len(ws) > 0)),
d as (select row_number() over () n, doc_id, {words} ws from documents),
dw as (select n, z, i, array_to_string(ws[i + 1 : i + z], ' ') w from (select n, ws, z, unnest(range(0, len(ws) - z + 1)) i
  from d, (select distinct z from bw) s where len(ws) >= z)),
m as (select distinct n, item, dw.z, i from dw join bw on dw.w = bw.w and dw.z = bw.z),
h as (select n, count(distinct p) n_hit from (select n, unnest(range(i, i + z)) p from (select distinct n, z, i from m)) group by n),
i as (select n, count(distinct item) n_items, sha256(coalesce(string_agg(distinct item, ',' order by item), '')) s from m group by n)
select doc_id, cast(len(ws) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items, coalesce(s, sha256('')) items_sha256, n_hit is not null contaminated
from d left join h on d.n = h.n left join i on d.n = i.n"""
