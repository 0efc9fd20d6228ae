"""Removing repeated runs of lines, by a suffix array over line ids.

A document is the sequence of its lines with a word. A run of neighbouring lines with at
least ``min_chars`` code points in all that also occurs earlier (in an earlier document,
or earlier in the same one; occurrences may overlap) is deleted; the first copy stays.
Maximal runs are unions of overlapping minimal ones, so it is enough to look at the runs
that are minimal from their first or from their last line.

*Suffix array.* Lines get ranks in the order of their hashes; lines that occur once end
every common prefix and are left out. Prefix doubling then ranks windows of 2, 4, 8 ...
lines by the pair of ranks of their halves, sorted over range partitions; windows that
occur once are left out of the next round. The rank of a window of any length is given
by the ranks of two overlapping windows of a power of two.

*LCP intervals.* Suffixes whose common prefix covers the run share that pair of ranks:
they are an interval of the suffix array. Its first member in document order keeps the
run, and all others lose it.

Lines without a word are never part of a run and stay where other lines stay.

Defined results: a null text is kept as null, an empty one as empty. Rows equal in id and
text are one document and keep or lose the same lines. Documents are ordered by id, then
by a hash of the text; a null id comes first. A document that loses all its lines is
returned with an empty text by ``deduplicated`` and is left out by ``remaining``. Other
columns are kept and may have any name. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import bound, join_small, stage, text_of

MIN_CHARS = 100  # any 51 words with blanks between them have at least 101 code points
DOC = ["_line_id", "_line_key"]


def keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_line_id", F.coalesce(docs["doc_id"].cast("bigint"), F.lit(-1 << 63))).withColumn(
        "_line_key", F.xxhash64(text_of(docs))
    )


def _has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def line_table(docs: DataFrame) -> DataFrame:
    """Lines with a word: document, place among them, index in the text, id and length."""
    lines = F.transform(F.split(F.col("_line_text"), "\n"), lambda line, i: F.struct(line.alias("line"), i.alias("i")))
    filled = F.filter(lines, lambda e: _has_word(e["line"]))
    # Two hashes, 96 bits, name a line.
    named = F.transform(filled, lambda e: F.struct(
        F.xxhash64(e["line"]).alias("h1"), F.hash(e["line"]).alias("h2"), F.length(e["line"]).alias("chars"), e["i"].alias("i")
    ))
    return keyed(docs).select(*DOC, text_of(docs).alias("_line_text")).select(
        *DOC, F.posexplode(named).alias("p", "line")
    ).select(*DOC, "p", "line.*")


def ranked_keys(keys: DataFrame, columns: list[str]) -> tuple[DataFrame, int]:
    """Distinct repeated keys with ranks in their order, and their number."""
    ordered = keys.groupBy(*columns).count().filter("count > 1").drop("count").orderBy(*columns)
    ranks = stage(ordered.withColumn("r", F.monotonically_increasing_id()), "lines-ranks")
    return ranks, ranks.count()


def minimal_runs(alive: DataFrame, min_chars: int) -> DataFrame:
    """Runs ``(document, a, n)`` of repeated lines, minimal from the left or the right.

    Running sums and as-of lookups, each one ordered pass over a stretch of neighbours.
    """
    by_doc = Window.partitionBy(*DOC).orderBy("p")
    stretch = alive.withColumn("s", F.col("p") - F.row_number().over(by_doc))
    here = [*DOC, "s"]
    upto = Window.partitionBy(*here).orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    sums = stage(
        stretch.withColumn("c", F.sum("chars").over(upto)).withColumn("d", F.col("c") - F.col("chars")), "lines-sums"
    )
    # The first line b with c(b) >= d(a) + min_chars, and the last line a with d(a) <= c(b) - min_chars.
    ends = sums.select(*here, F.col("c").alias("v"), F.lit(0).alias("asks"), "p")
    starts = sums.select(*here, F.col("d").alias("v"), F.lit(0).alias("asks"), "p")
    from_left = ends.union(sums.select(*here, F.col("d") + min_chars, F.lit(1), "p"))
    from_right = starts.union(sums.select(*here, F.col("c") - min_chars, F.lit(1), "p"))
    hit = F.when(F.col("asks") == 0, F.col("p"))
    down = Window.partitionBy(*here).orderBy(F.desc("v"), "asks", F.desc("p")).rowsBetween(Window.unboundedPreceding, 0)
    up = Window.partitionBy(*here).orderBy("v", "asks", "p").rowsBetween(Window.unboundedPreceding, 0)
    left = from_left.withColumn("b", F.last(hit, True).over(down)).filter("asks = 1 and b is not null").select(
        *DOC, F.col("p").alias("a"), (F.col("b") - F.col("p") + 1).alias("n")
    )
    right = from_right.withColumn("a", F.last(hit, True).over(up)).filter("asks = 1 and a is not null").select(
        *DOC, "a", (F.col("p") - F.col("a") + 1).alias("n")
    )
    return left.union(right).distinct()


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Document and index of every line to delete."""
    lines = stage(line_table(docs), "lines-all")
    names, n_names = ranked_keys(lines.select("h1", "h2"), ["h1", "h2"])
    alive = stage(
        join_small(lines, names, ["h1", "h2"], n_names, 24).select(*DOC, "p", "i", "chars", "r").distinct(), "lines-alive"
    )
    runs = stage(minimal_runs(alive, min_chars).withColumn("k", F.length(F.bin("n")) - 1), "lines-runs")
    top = runs.agg(F.max("k")).first()[0]
    if top is None:
        return alive.select(*DOC, "i").limit(0)
    level = alive.select(*DOC, "p", "r")
    levels = level.withColumn("k", F.lit(0))
    for k in range(top):
        ahead = level.select(*DOC, (F.col("p") - (1 << k)).alias("p"), F.col("r").alias("r2"))
        pairs = stage(level.withColumnRenamed("r", "r1").join(ahead, [*DOC, "p"]), "lines-pairs")
        names, n_names = ranked_keys(pairs, ["r1", "r2"])
        if not n_names:
            break
        level = stage(join_small(pairs, names, ["r1", "r2"], n_names, 24).select(*DOC, "p", "r"), "lines-level")
        levels = levels.union(level.withColumn("k", F.lit(k + 1)))
    head = levels.select(*DOC, F.col("p").alias("a"), "k", F.col("r").alias("r1"))
    tail = levels.select(*DOC, F.col("p").alias("t"), "k", F.col("r").alias("r2"))
    placed = stage(
        runs.join(head, [*DOC, "a", "k"]).withColumn("t", F.expr("a + n - cast(shiftleft(1, k) as int)"))
        .join(tail, [*DOC, "t", "k"]).select(*DOC, "a", "n", "r1", "r2"), "lines-placed",
    )
    interval = ["n", "r1", "r2"]
    first = stage(
        placed.groupBy(*interval).agg(F.min(F.struct(*DOC, "a")).alias("first"), F.max(F.struct(*DOC, "a")).alias("last"))
        .filter("first <> last").drop("last"), "lines-intervals",
    )
    later = join_small(placed, first, interval, first.count(), 56).filter(
        F.struct(*DOC, "a") != F.col("first")
    )
    gone = later.select(*DOC, F.explode(F.expr("sequence(a, a + n - 1)")).alias("p")).distinct()
    return alive.join(gone, [*DOC, "p"], "left_semi").select(*DOC, "i")


def _cleaned(docs: DataFrame, min_chars: int) -> DataFrame:
    """``docs`` with the new text and the number of deleted lines in spare columns."""
    gone = stage(
        repeated_lines(docs, min_chars).groupBy(*DOC).agg(F.collect_set("i").alias("_line_gone")), "lines-gone"
    )
    n, lines = gone.agg(F.count("*"), F.coalesce(F.sum(F.size("_line_gone")), F.lit(0))).first()
    both = join_small(keyed(docs), gone, DOC, n, 64 + 16 * lines // max(n, 1), "left")
    lost = F.col("_line_gone")
    kept = bound(F.split(docs["text"], "\n"), lambda rows: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(rows) - 1), lost), lambda i: F.get(rows, i)
    ))
    return both.withColumn(
        "_line_text", F.when(lost.isNull(), docs["text"]).otherwise(F.array_join(kept, "\n"))
    ).withColumn("_line_lost", F.when(lost.isNull(), 0).otherwise(F.size(lost)).cast("bigint"))


def deduplicated(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Every document with its text without repeated runs, ``n_lines`` and ``n_removed``.

    ``n_lines`` counts the lines with a word before deletion.
    """
    total = F.size(F.filter(F.split(text_of(docs), "\n"), _has_word)).cast("bigint")
    out = _cleaned(docs, min_chars)
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", "n_lines", "n_removed")]
    return out.select(*others, F.col("_line_text").alias("text"), total.alias("n_lines"), F.col("_line_lost").alias("n_removed"))


def remaining(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents with new texts and their own columns, without those that lost all words."""
    out = _cleaned(docs, min_chars).filter((F.col("_line_lost") == 0) | _has_word(F.col("_line_text")))
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("_line_text").alias("text"))
        elif c == "n_chars":
            columns.append(F.when(F.col("_line_lost") > 0, F.length("_line_text").cast("bigint")).otherwise(docs["n_chars"]).alias("n_chars"))
        else:
            columns.append(F.col(f"`{c}`"))
    return out.select(*columns)


def oracle_sql() -> str:
    """The same by comparing the runs' texts; ids are unique in the test tables."""
    return rf"""
    with l as (select doc_id, i, line, length(line) w, row_number() over (partition by doc_id order by i) p
               from (select doc_id, unnest(string_split(text, chr(10))) line, unnest(range(len(string_split(text, chr(10))))) i from documents)
               where regexp_matches(line, '[^\x20\x09-\x0D]')),
    rep as (select line from l group by line having count(*) > 1),
    al as (select l.*, sum(w) over (partition by doc_id order by p) c from l),
    ok as (select *, c - w d from al where line in (select line from rep)),
    -- Runs: from each line to the first that fills the length, and back.
    r1 as (select a.doc_id, a.p a, min(b.p) b from ok a join al b on a.doc_id = b.doc_id and b.p >= a.p and b.p < a.p + {MIN_CHARS} and b.c >= a.d + {MIN_CHARS} group by all),
    r2 as (select b.doc_id, max(a.p) a, b.p b from ok b join al a on a.doc_id = b.doc_id and a.p <= b.p and a.p > b.p - {MIN_CHARS} and b.c >= a.c - a.w + {MIN_CHARS} group by all),
    r as (select * from r1 union select * from r2),
    t as (select r.doc_id, a, b, string_agg(line, chr(10) order by p) g from r join al on al.doc_id = r.doc_id and p between a and b group by all),
    f as (select *, row_number() over (partition by g order by doc_id, a) k from t),
    gone as (select distinct f.doc_id, p from f join al on al.doc_id = f.doc_id and p between a and b where k > 1),
    gi as (select gone.doc_id, l.i from gone join l using (doc_id, p)),
    x as (select d.doc_id, unnest(string_split(text, chr(10))) line, unnest(range(len(string_split(text, chr(10))))) i from documents d),
    y as (select x.doc_id, string_agg(line, chr(10) order by x.i) filter (gi.i is null) text, count(gi.i) n_removed
          from x left join gi on x.doc_id = gi.doc_id and x.i = gi.i group by x.doc_id)
    select d.doc_id, (select count(*) from l where l.doc_id = d.doc_id) n_lines, coalesce(n_removed, 0) n_removed,
           sha256(coalesce(y.text, '')) text_sha256
    from documents d left join y on d.doc_id = y.doc_id"""
