"""Personal data: patterns propose spans, checksums confirm them, context adjusts the score.

Patterns run on the JVM. The places of the matches follow from the lengths of the gaps
between them, so a text is read once for its matches and once for its gaps, and only if
it holds a character without which the pattern cannot match. Patterns begin only where a
match can begin and give nothing back, so long runs cost one pass; the spans are those
that the plain patterns in ``BASE`` give, leftmost and non-overlapping per kind.

Kinds with a checksum or a digit count are dropped where it fails, without another try
inside the match. Every span has a score from 0 to 1: that of its kind, raised by context words of the
kind within 40 code points on either side and lowered by words that name something else
there. Base kinds are always reported; the three added kinds are reported if their score
reaches the threshold: an IBAN passes mod 97, which is enough; an identity number and a
secret (a key or token) need a raising word and no lowering one. A secret is a run of 20
to 512 letters, digits, ``_`` and ``-`` with a letter and a digit, whose characters are so even that the
collision entropy is 3 bits or more.

Defined results: a null or empty text has no spans and an empty list. Positions are code
points, ends exclusive. Rows are treated alone, so repeated rows and null ids give rows
like any other. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import text_of

# The given plain patterns, in the order of the kinds.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = ("email", "ip", "card", "phone", "iban", "id_number", "secret")

# The same matches without needless starts and without backtracking.
_FAST = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}+(?![A-Za-z0-9])",
    "id_number": r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])",
    "secret": r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,512}+(?![A-Za-z0-9_-])",
}
_NEEDS = {"email": "@", "ip": ".", "phone": "+", "id_number": "-"}
# Hundredths of the score of a span that its check confirmed, the words beside it that raise the score, and those
# that lower it.
_SCORES = {"email": 90, "ip": 60, "card": 80, "phone": 60, "iban": 90, "id_number": 30, "secret": 30}
_CONTEXT = {
    "email": "e-?mail|contact|write to", "ip": "ip|address|host|server", "card": "card|visa|credit|payment",
    "phone": "phone|tel|call|mobile|fax", "iban": "iban|account|bank", "id_number": "ssn|social security|identity",
    "secret": "token|secret|passw|credential|bearer|api[ _-]?key|access[ _-]?key|private[ _-]?key|authorization",
}
_AGAINST = {
    "email": "no-?reply|example", "ip": "version|release|section", "card": "order|tracking|serial|isbn",
    "phone": "order|serial|isbn", "iban": "serial|part number", "id_number": "order|invoice|part number|serial",
    "secret": "commit|revision|checksum|digest|md5|sha-?1|sha-?256",
}
CONTEXT_SCORE = 30
CONTEXT_REACH = 40
THRESHOLD = 0.5

_FOUND = "array<struct<start:int,end:int,value:string>>"


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    size = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when((size - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), size), F.lit(0), add) % 10 == 0


def mod97(code: Column) -> Column:
    moved = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))

    def add(rest: Column, i: Column) -> Column:
        c = F.ascii(F.substring(moved, i, F.lit(1)))
        return (F.when(c < 58, rest * 10 + c - 48).otherwise(rest * 100 + c - 55) % 97).cast("int")

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add) == 1


def _small(part: Column) -> Column:
    stripped = F.regexp_replace(part, "^0+", "")
    return (F.length(stripped) <= 3) & (F.lpad(stripped, 3, "0") <= "255")


def even(value: Column) -> Column:
    """A letter, a digit, and at least 3 bits of collision entropy: the squared counts of its characters add up to an
    eighth of its squared length at most."""
    size = F.length(value)
    count = lambda c: size - F.length(F.replace(value, c, F.lit("")))
    squares = F.aggregate(F.array_distinct(F.split(value, "")), F.lit(0), lambda total, c: total + F.when(c != "", count(c) * count(c)).otherwise(0))
    return value.rlike("[A-Za-z]") & value.rlike("[0-9]") & (8 * squares <= size * size)


def confirmed(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), _small)
    if kind == "card":
        return luhn(digits_of(value))
    if kind == "phone":
        return F.length(digits_of(value)).between(10, 15)
    if kind == "iban":
        return mod97(value)
    if kind == "secret":
        return even(value)
    return F.lit(True)


def located(text: Column, pattern: str) -> Column:
    """Start, end and value of every match."""
    parts = F.zip_with(
        F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, match: F.struct(F.length(gap).alias("gap"), match.alias("match")),
    )

    def add(state: Column, part: Column) -> Column:
        start = state["at"] + part["gap"]
        end = start + F.coalesce(F.length(part["match"]), F.lit(0))
        found = F.array(F.struct(start.alias("start"), end.alias("end"), part["match"].alias("value")))
        return F.struct(end.alias("at"), F.concat(state["found"], found).alias("found"))

    state = F.struct(F.lit(0).alias("at"), F.array().cast(_FOUND).alias("found"))
    return F.filter(F.aggregate(parts, state, add, lambda s: s["found"]), lambda s: s["value"].isNotNull())


def spans_of(text: Column, kind: str) -> Column:
    """Confirmed spans of one kind with their scores."""
    def scored(s: Column) -> Column:
        first = F.greatest(s["start"] - CONTEXT_REACH, F.lit(0))
        before = F.lower(F.substring(text, first + 1, s["start"] - first))
        after = F.lower(F.substring(text, s["end"] + 1, F.lit(CONTEXT_REACH)))
        beside = lambda words: F.when(before.rlike(words) | after.rlike(words), CONTEXT_SCORE).otherwise(0)
        score = F.least(F.lit(_SCORES[kind]) + beside(_CONTEXT[kind]) - beside(_AGAINST[kind]), F.lit(100)) / 100
        return F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("place"), s["end"].alias("end"),
            F.lit(kind).alias("kind"), s["value"].alias("value"), score.alias("score"),
        )

    spans = F.transform(F.filter(located(text, _FAST[kind]), lambda s: confirmed(kind, s["value"])), scored)
    possible = text.rlike(_FAST[kind]) if kind not in _NEEDS else text.contains(_NEEDS[kind]) & text.rlike(_FAST[kind])
    return F.when(possible, spans).otherwise(
        F.array().cast("array<struct<start:int,place:int,end:int,kind:string,value:string,score:double>>")
    )


def found_pii(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id`` and ``found``: spans by start, then kind, each with value and score."""
    text = F.col("_text")
    kinds = [
        spans_of(text, kind) if kind in BASE else F.filter(spans_of(text, kind), lambda s: s["score"] >= threshold)
        for kind in KINDS
    ]
    return docs.select(docs["doc_id"].alias("doc_id"), text_of(docs).alias("_text")).select(
        "doc_id", F.array_sort(F.concat(*kinds)).alias("found")
    )


def joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts, the checksum of the base spans, all spans as text, and their scores in hundredths in the same order."""
    spans = F.col("found")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
    base = F.filter(spans, lambda s: s["place"] < len(BASE))
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(spans).alias("spans"),
        *[count(kind).alias(f"n_{kind}") for kind in KINDS[len(BASE):]], F.size(spans).cast("bigint").alias("n_spans"),
        F.array_join(F.transform(spans, lambda s: F.round(s["score"] * 100).cast("int").cast("string")), ",").alias("scores"),
    )


def _oracle_kind(kind: str, pattern: str, where: str) -> str:
    near = f"(lower(substring(t, greatest(e - length(v) - {CONTEXT_REACH}, 0) + 1, least({CONTEXT_REACH}, e - length(v)))), lower(substring(t, e + 1, {CONTEXT_REACH})))"
    words = lambda given: f"(case when regexp_matches({near}[1], '{given}') or regexp_matches({near}[2], '{given}') then {CONTEXT_SCORE} else 0 end)"
    return f"""
      select * from (select doc_id, n, '{kind}' kind, {KINDS.index(kind)} place, cast(e - length(v) as integer) s, cast(e as integer) e,
        least({_SCORES[kind]} + {words(_CONTEXT[kind])} - {words(_AGAINST[kind])}, 100) score from (
        select doc_id, n, v, t, cast(sum(coalesce(length(g), 0) + coalesce(length(v), 0)) over (partition by n order by i rows unbounded preceding) as integer) e
        from (select doc_id, n, t, unnest(regexp_extract_all(t, '{pattern}')) v, unnest(string_split_regex(t, '{pattern}')) g,
                     unnest(range(len(string_split_regex(t, '{pattern}')))) i from d))
      where v is not null and {where}) x where place < {len(BASE)} or score >= {round(100 * THRESHOLD)}"""


def oracle_sql() -> str:
    """The same in SQL, from the plain patterns."""
    digit = "regexp_replace(v, '[^0-9]', '', 'g')"
    luhn_sum = (
        f"list_sum(list_transform(range(1, length({digit}) + 1), lambda i: case when (length({digit}) - i) % 2 = 1 then "
        f"case when cast({digit}[i] as integer) > 4 then 2 * cast({digit}[i] as integer) - 9 else 2 * cast({digit}[i] as integer) end "
        f"else cast({digit}[i] as integer) end))"
    )
    iban = (
        "list_reduce(list_prepend(0, list_transform(string_split(v[5:] || v[1:4], ''), lambda c: case when c <= '9' then ascii(c) - 48 else ascii(c) + 945 end)), "
        "lambda r, c: case when c < 1000 then (r * 10 + c) % 97 else (r * 100 + c - 1000) % 97 end) = 1"
    )
    parts = " union all ".join([
        _oracle_kind("email", BASE["email"], "true"),
        _oracle_kind("ip", BASE["ip"], "len(list_filter(string_split(v, '.'), lambda p: cast(p as hugeint) > 255)) = 0"),
        _oracle_kind("card", BASE["card"], f"length({digit}) between 14 and 19 and {luhn_sum} % 10 = 0"),
        _oracle_kind("phone", BASE["phone"], f"length({digit}) between 10 and 15"),
        _oracle_kind("iban", "[A-Za-z0-9]+", f"regexp_full_match(v, '[A-Z][A-Z][0-9][0-9][A-Z0-9]{{11,30}}') and {iban}"),
        _oracle_kind("id_number", "[A-Za-z0-9-]+", "regexp_full_match(v, '[0-9]{3}-[0-9]{2}-[0-9]{4}')"),
        _oracle_kind("secret", "[A-Za-z0-9_-]{20,}", "length(v) <= 512 and regexp_matches(v, '[A-Za-z]') and regexp_matches(v, '[0-9]') and "
                     "8 * list_sum(list_transform(map_values(list_histogram(string_split(v, ''))), lambda c: c * c)) <= length(v) * length(v)"),
    ])
    return f"""
    with d as (select doc_id, row_number() over () n, coalesce(text, '') t from documents),
    s as ({parts}),
    g as (select n, count(*) filter (kind = 'email') n_email, count(*) filter (kind = 'ip') n_ip,
                 count(*) filter (kind = 'card') n_card, count(*) filter (kind = 'phone') n_phone,
                 string_agg(kind || ':' || s || ':' || e, ',' order by s, place) filter (place < {len(BASE)}) base,
                 string_agg(kind || ':' || s || ':' || e, ',' order by s, place) spans,
                 count(*) filter (kind = 'iban') n_iban, count(*) filter (kind = 'id_number') n_id_number, count(*) filter (kind = 'secret') n_secret,
                 count(*) n_spans, string_agg(cast(score as varchar), ',' order by s, place) scores from s group by n)
    select doc_id, coalesce(n_email, 0) n_email, coalesce(n_ip, 0) n_ip, coalesce(n_card, 0) n_card,
           coalesce(n_phone, 0) n_phone, sha256(coalesce(base, '')) base_sha256, coalesce(spans, '') spans,
           coalesce(n_iban, 0) n_iban, coalesce(n_id_number, 0) n_id_number, coalesce(n_secret, 0) n_secret, coalesce(n_spans, 0) n_spans, coalesce(scores, '') scores
    from d left join g using (n)"""
