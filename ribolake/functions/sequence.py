"""Expressions over nucleotide and quality strings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# IUPAC nucleotide codes and their complements, position by position.
IUPAC_BASES = "ACGTURYKMSWBDHVN"
IUPAC_COMPLEMENTS = "TGCAAYRMKSWVHDBN"

# Fixed value: the characters that encode Phred 0 to 14 at offset 33.
PHRED_BELOW_15 = "!\"#$%&'()*+,-./"


def normalise(seq: Column) -> Column:
    """Upper case, RNA written as DNA."""
    return F.translate(F.upper(seq), "U", "T")


def revcomp(seq: Column) -> Column:
    """Reverse complement; gaps and unknown characters keep their value."""
    return F.reverse(F.translate(F.upper(seq), IUPAC_BASES, IUPAC_COMPLEMENTS))


def has_ambiguous(seq: Column) -> Column:
    """True where a character other than A, C, G, T occurs."""
    return seq.rlike("[^ACGT]")


def strip_gaps(seq: Column) -> Column:
    """Remove alignment gaps and white space."""
    return F.translate(seq, "-. \t", "")


def constant_quality(seq: Column, symbol: str = "I") -> Column:
    """A quality string of one repeated symbol, as long as the sequence."""
    return F.repeat(F.lit(symbol), F.length(seq))


def hamming(a: Column, b: Column) -> Column:
    """Number of differing positions of two strings of equal length."""
    differs = F.filter(
        F.sequence(F.lit(1), F.length(a)),
        lambda i: F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1)),
    )
    return F.when(F.length(a) > 0, F.size(differs)).otherwise(0)


def mismatches_up_to(a: Column, b: Column, limit: int) -> Column:
    """Substitutions between two strings of equal length, or null above ``limit``.

    The edit distance never exceeds the Hamming distance, so it screens out most
    pairs before the position-wise count, which alone decides above one.
    """
    if limit == 0:
        return F.when(a == b, F.lit(0))
    distance = F.levenshtein(a, b, limit)
    if limit == 1:
        return F.when(distance >= 0, distance)
    exact = hamming(a, b)
    return F.when(distance < 0, F.lit(None).cast("int")).when(exact <= limit, exact)


def low_quality_bases(qual: Column) -> Column:
    """How many bases lie below Phred 15."""
    return F.length(qual) - F.length(F.translate(qual, PHRED_BELOW_15, ""))


def count_of(seq: Column, letters: str) -> Column:
    """How many characters of ``seq`` are among ``letters``."""
    # A replacement is a search in bytes; a translation looks up every character.
    rest = seq
    for letter in letters:
        rest = F.replace(rest, F.lit(letter))
    return F.length(seq) - F.length(rest)


def without_adapter(seq: Column, adapter: str, min_overlap: int = 4) -> Column:
    """The read before its 3' adapter.

    The whole adapter anywhere in the read comes first; otherwise the longest read
    end that is a beginning of the adapter, down to ``min_overlap`` bases. One pattern
    does both: a partial adapter at the end always starts right of a whole one.
    """
    tail = ""
    for base in reversed(adapter[min_overlap:-1]):
        tail = f"(?:{base}{tail})?"
    return F.regexp_replace(seq, rf"{adapter}.*\z|{adapter[:min_overlap]}{tail}\z", "")


def kept_length(seq: Column, adapter: Column, min_overlap: int = 4) -> Column:
    """Bases before a 3' adapter that differs from row to row; null without adapter.

    The same rule as ``without_adapter``.
    """
    whole = F.call_function("instr", seq, adapter)
    ends = F.filter(
        F.sequence(F.least(F.length(adapter) - 1, F.length(seq)), F.lit(min_overlap), F.lit(-1)),
        lambda n: F.endswith(seq, F.substring(adapter, F.lit(1), n)),
    )
    possible = F.least(F.length(adapter) - 1, F.length(seq)) >= min_overlap
    partial = F.when(possible, F.coalesce(F.get(ends, F.lit(0)), F.lit(0))).otherwise(0)
    return F.when(whole > 0, whole - 1).when(adapter.isNotNull(), F.length(seq) - partial)


def kept_length_with_errors(seq: Column, adapter: str, max_share: float, min_overlap: int = 4) -> Column:
    """Bases before the leftmost place from which the read goes on as the adapter, but for errors.

    At each place as much of the adapter is compared as the read still holds, ``min_overlap``
    bases or more; at most ``max_share`` of the compared bases, rounded down, may differ.
    """
    size, whole, most = F.length(seq), F.lit(adapter), int(len(adapter) * max_share + 1e-9)
    anywhere = _adapter_screen(adapter, max_share, min_overlap)

    def close(at: Column) -> Column:
        n = F.least(size - at, F.lit(len(adapter)))
        limit = F.floor(n * F.lit(float(max_share)) + F.lit(1e-9)).cast("int")
        own, wanted = F.substring(seq, at + 1, n), F.substring(whole, F.lit(1), n)
        # The banded edit distance, never above the number of misread bases, ends most random places.
        return F.when(limit == 0, own == wanted).otherwise((F.levenshtein(own, wanted, most) >= 0) & (hamming(own, wanted) <= limit))

    places = F.filter(F.sequence(F.lit(0), size - min_overlap), close)
    return F.when((size < min_overlap) | ~seq.rlike(anywhere), size).otherwise(F.coalesce(F.get(places, F.lit(0)), size))


def _adapter_screen(adapter: str, max_share: float, min_overlap: int) -> str:
    """A pattern that every read with an adapter holds.

    Of the first bases compared, cut into one piece more than errors are allowed, one piece is exact.
    """
    parts, shortest = [], {}
    for n in range(min_overlap, len(adapter) + 1):
        limit = int(n * max_share + 1e-9)
        shortest.setdefault(limit, n)
        if limit == 0:
            parts.append(adapter[:n] + (r"\z" if n < len(adapter) else ""))
    for limit, n in shortest.items():
        step = n // (limit + 1)
        if not step:
            return ""
        parts += [adapter[i * step:(i + 1) * step] for i in range(limit + 1) if limit]
    return "|".join(dict.fromkeys(parts))


def two_decimals(value: Column) -> Column:
    """Text with two decimals, the number format of the summary files."""
    return F.format_string("%.2f", value.cast("double"))
