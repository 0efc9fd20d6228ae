"""Quality rules with thresholds whose false rejections are bounded.

A rule rejects a document whose metric is above a cutoff. Cutoffs come from labelled
documents, per stratum (language). In one fixed sequence of steps one rule after the other
is tightened along its grid, from no cutoff to the tightest, and a step is accepted while the
exact binomial test rejects "the rules together would lose more than ``alpha`` of the good
documents that the base rules keep". The walk stops at the first failure, so the tests along the steps need no
correction among each other; strata are corrected by Bonferroni. With probability
``1 - delta`` no stratum then loses more than ``alpha`` of these. A stratum
without enough labels (437 good ones for four strata and no losses) gets no cutoff and
rejects nothing.

All counts are JVM expressions inside a row: no row is exploded, and nothing but narrow
metrics is shuffled.

Defined results: a null or empty text has no words and fails the base rules. A null
stratum is a stratum of its own. Null labels and labels of an id that contradict each
other are not used; repeated equal labels count once. Repeated documents are labelled
and judged alike. No labels give no cutoffs, no documents no rows. Other columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import bound, join_small, source_key, stage, text_of, words

WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"

# Metric and its grid of cutoffs, loosest first. The rules are tightened in this order: signs
# and overlong words are rare in prose, repetition is not.
GRIDS = {
    "symbol_share": (300, 200, 150, 100, 70, 50, 30, 20),
    "word_length": (2500, 2000, 1700, 1500, 1300, 1200, 1100, 1000),
    "repeat_share": (300, 250, 200, 150, 100, 70, 50, 30),
    "dup_line_share": (500, 400, 300, 250, 200, 150, 100, 50),
}
STEPS = sum(map(len, GRIDS.values()))
ALPHA = 0.01
DELTA = 0.05


def repeated_words(ws: Column) -> Column:
    """Words inside ``WINDOW``-word windows that occur twice or more, each word once."""
    windows = F.transform(
        F.sequence(F.lit(1), F.size(ws) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(ws, i, F.lit(WINDOW)))
    )

    def covered(hashes: Column) -> Column:
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        starts = bound(ordered, lambda s: F.transform(s, lambda e, j: F.when(
            F.coalesce(F.get(s, j - 1)["h"] == e["h"], F.lit(False))
            | F.coalesce(F.get(s, j + 1)["h"] == e["h"], F.lit(False)), e["i"],
        )))
        return F.aggregate(
            F.array_sort(F.filter(starts, lambda i: i.isNotNull())),
            F.struct(F.lit(0).alias("end"), F.lit(0).alias("total")),
            lambda s, i: F.struct(
                (i + WINDOW).alias("end"), (s["total"] + i + WINDOW - F.greatest(i, s["end"])).alias("total")
            ),
            lambda s: s["total"],
        )

    return F.when(F.size(ws) <= WINDOW, 0).otherwise(
        bound(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h)))
    )


def metrics(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """Counts of every document, with its stratum key."""
    text = F.col("_text")
    of_words = bound(words(text), lambda ws: F.struct(
        F.size(ws).cast("bigint").alias("n_words"), F.length(F.array_join(ws, "")).cast("bigint").alias("word_chars"),
        repeated_words(ws).cast("bigint").alias("n_repeat_words"),
    ))
    filled = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    of_lines = bound(filled, lambda lines: F.struct(
        F.size(lines).cast("bigint").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
    ))
    symbols = F.length(text) - F.length(F.regexp_replace(text, f"[{SYMBOLS}]", ""))
    return docs.select(
        docs["doc_id"].alias("doc_id"), source_key(docs[stratum]).alias("stratum"), text_of(docs).alias("_text")
    ).select(
        "doc_id", "stratum", of_words.alias("w"), of_lines.alias("l"), symbols.cast("bigint").alias("n_symbols")
    ).select("doc_id", "stratum", "w.*", "l.*", "n_symbols")


def rule_values(counts: DataFrame) -> DataFrame:
    """Add the base verdict and the metrics of the rules, as whole numbers."""
    per = lambda a, b, scale: F.when(F.col(b) > 0, F.expr(f"({scale} * {a}) div {b}")).otherwise(0)
    return counts.withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")),
    ).withColumns({
        "symbol_share": per("n_symbols", "word_chars", 1000), "dup_line_share": per("n_dup_lines", "n_lines", 1000),
        "repeat_share": per("n_repeat_words", "n_words", 1000), "word_length": per("word_chars", "n_words", 100),
    })


def usable_labels(labels: DataFrame, column: str = "quality") -> DataFrame:
    """One row per id whose labels agree."""
    return (
        labels.filter(labels["doc_id"].isNotNull() & labels[column].isNotNull()).groupBy("doc_id")
        .agg(F.min(column).alias("low"), F.max(column).alias("label")).filter("low = label").select("doc_id", "label")
    )


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """Logarithm of P(X <= k) for X binomial with n trials of chance p, term by term."""
    import math

    odds = math.log(p / (1 - p))

    def add(state: Column, j: Column) -> Column:
        term = state["term"] + F.log((n - j + 1) / j) + F.lit(odds)
        high = F.greatest(term, state["sum"])
        return F.struct(
            term.alias("term"), (high + F.log1p(F.exp(F.least(term, state["sum"]) - high))).alias("sum")
        )

    first = n * F.lit(math.log1p(-p))
    terms = F.when(k > 0, F.sequence(F.lit(1).cast("bigint"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(terms, F.struct(first.alias("term"), first.alias("sum")), add, lambda s: s["sum"])


def certified(holdout: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The accepted cutoffs of each stratum that has any, one column a rule, and the step they are of.

    ``holdout`` has the good documents with stratum and metrics. Per stratum only the
    counts between neighbouring steps are kept.
    """
    # A document above j cutoffs of a rule lies above the j tightest, which are its last steps.
    lost_at, done = [], 0
    for rule, grid in GRIDS.items():
        above = sum((F.when(F.col(rule) > c, 1).otherwise(0) for c in grid), F.lit(0))
        lost_at.append(F.when(above > 0, F.lit(done + len(grid) + 1) - above))
        done += len(grid)
    first = F.coalesce(F.least(*lost_at), F.lit(STEPS + 1))
    counted = holdout.groupBy("stratum", first.alias("first")).count()
    per_stratum = stage(counted.groupBy("stratum").agg(F.sum("count").alias("n"), F.map_from_entries(
        F.collect_list(F.struct("first", "count"))).alias("by_place")), "rules-counts")  # at most one entry a step
    strata = max(per_stratum.count(), 1)
    lost = F.aggregate(
        F.map_entries("by_place"), F.lit(0).cast("bigint"),
        lambda total, e: total + F.when(e["key"] <= F.col("step"), e["value"]).otherwise(0),
    )
    tests = (
        per_stratum.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(STEPS)))).withColumn("k", lost)
        .withColumn("passed", F.when(F.col("k") >= F.col("n") * alpha, False).otherwise(
            binomial_tail(F.col("n"), F.col("k"), alpha) <= F.log(F.lit(delta / strata))
        ))
    )
    walk = Window.partitionBy("stratum").orderBy("step")
    accepted = tests.withColumn("all_passed", F.min("passed").over(walk)).filter("all_passed")
    cutoffs, done = [], 0
    for rule, grid in GRIDS.items():
        own = F.least(F.col("step") - done, F.lit(len(grid)))
        cutoffs.append(F.when(own > 0, F.get(F.array(*map(F.lit, grid)), own - 1)).alias(f"{rule}_cutoff"))
        done += len(grid)
    return accepted.groupBy("stratum").agg(F.max("step").alias("step")).select("stratum", "step", *cutoffs)


def judged(docs: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Every document with its counts, the base verdict and ``kept``."""
    values = rule_values(stage(metrics(docs, stratum), "rules-metrics"))
    good = usable_labels(labels).filter("label = 1").select("doc_id")
    # What the base rules reject is not lost by the certified ones.
    holdout = values.filter(~F.col("base_failed")).join(good, "doc_id", "left_semi")
    cutoffs = stage(certified(holdout, alpha, delta), "rules-cutoffs")
    over = F.lit(False)
    for rule in GRIDS:
        over = over | F.coalesce(F.col(rule) > F.col(f"{rule}_cutoff"), F.lit(False))
    return join_small(values, cutoffs, ["stratum"], cutoffs.count(), how="left").withColumn(
        "kept", ~F.col("base_failed") & ~over
    )


def oracle_sql() -> str:
    word = r"[^\x20\x09-\x0D]+"
    rows, done = [], 0
    for grid in GRIDS.values():
        rows.append([str(grid[min(i - done, len(grid) - 1)]) if i >= done else "cast(null as int)" for i in range(STEPS)])
        done += len(grid)
    grid = ", ".join(f"({i + 1}, {', '.join(cuts)})" for i, cuts in enumerate(zip(*rows)))
    over = " or ".join(f"{r} > g.{r}_cut" for r in GRIDS)
    return rf"""
    with d as (select row_number() over () n, doc_id, case when lang is null then 'b' else 'a' || lang end stratum, coalesce(text, '') t from documents),
    w as (select n, unnest(ws) w, unnest(range(len(ws))) i from (select n, regexp_extract_all(t, '{word}') ws from d)),
    wc as (select n, count(*) n_words, sum(length(w)) word_chars from w group by n),
    win as (select n, i, string_agg(w, ' ') over (partition by n order by i rows between current row and {WINDOW - 1} following) g,
                   count(*) over (partition by n order by i rows between current row and {WINDOW - 1} following) c from w),
    rep as (select n, i from (select *, count(*) over (partition by n, g) m from win where c = {WINDOW}) where m > 1),
    cov as (select n, count(distinct i + j) n_repeat_words from rep, (select unnest(range({WINDOW})) j) group by n),
    ln as (select n, count(*) n_lines, count(*) - count(distinct l) n_dup_lines
           from (select n, unnest(string_split(t, chr(10))) l from d) where regexp_matches(l, '[^\x20\x09-\x0D]') group by n),
    v0 as (select d.n, doc_id, stratum, coalesce(n_words, 0) n_words, coalesce(word_chars, 0) word_chars,
                 length(t) - length(regexp_replace(t, '[{SYMBOLS}]', '', 'g')) n_symbols, coalesce(n_lines, 0) n_lines,
                 coalesce(n_dup_lines, 0) n_dup_lines, coalesce(n_repeat_words, 0) n_repeat_words
          from d left join wc on d.n = wc.n left join cov on d.n = cov.n left join ln on d.n = ln.n),
    v as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {REPEAT_PERCENT} * n_words base_failed,
                 case when word_chars > 0 then 1000 * n_symbols // word_chars else 0 end symbol_share,
                 case when n_lines > 0 then 1000 * n_dup_lines // n_lines else 0 end dup_line_share,
                 case when n_words > 0 then 1000 * n_repeat_words // n_words else 0 end repeat_share,
                 case when n_words > 0 then 100 * word_chars // n_words else 0 end word_length from v0),
    good as (select doc_id from labels where doc_id is not null and quality is not null group by doc_id having min(quality) = 1 and max(quality) = 1),
    h as (select * from v where not base_failed and doc_id in (select doc_id from good)),
    g(i, {', '.join(f'{r}_cut' for r in GRIDS)}) as (values {grid}),
    k as (select stratum, g.i, count(*) n, count(*) filter ({over}) k from h, g group by all),
    p as (select *, case when k >= n * {ALPHA} then false else
            list_sum(list_transform(range(k + 1), lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({ALPHA}) + (n - j) * ln(1 - {ALPHA}))))
            <= {DELTA} / (select count(distinct stratum) from k) end passed from k),
    a as (select stratum, max(i) i from (select *, bool_and(passed) over (partition by stratum order by i) ok from p) where ok group by all)
    select doc_id, n_words, cast(word_chars as bigint) word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           not base_failed and not exists (select 1 from a join g on g.i = a.i where a.stratum = v.stratum and ({over})) kept
    from v"""
