"""What the ids of transfer-RNA references say: species, amino acid, anticodon.

Every origin of a panel has its own way to write ids. A grammar is a pattern and the
groups that hold the fields; the first grammar that fits an id is used, ids that none
fits have no fields.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

FIELDS = ("species", "aa", "anticodon")


@dataclass(frozen=True)
class IdGrammar:
    """``groups`` gives the number of the pattern's group for each field it has."""

    origin: str
    pattern: str
    groups: dict[str, int]


# Customary forms of transfer-RNA ids.
TRNA_GRAMMARS = (
    # Homo_sapiens_tRNA-Ala-AGC-1-1, Mus_musculus_nmt-tRNA-Gln-TTG-3-1
    IdGrammar("genomic", r"^([A-Z][a-z]+_[A-Za-z0-9_.]+?)_(?:nmt-|mito-)?tRNA-([A-Za-z]+)-([ACGTUN]{3})-", {"species": 1, "aa": 2, "anticodon": 3}),
    # tdbD00000123|Escherichia_coli|562|Ala|TGC
    IdGrammar("curated", r"^(?:tdb|mttdb)[A-Z][0-9]+\|([^|]+)\|[0-9]*\|([A-Za-z]+)\|([ACGTUN]{3})", {"species": 1, "aa": 2, "anticodon": 3}),
    # chr6.trna34-AlaAGC, contig_12.trna1-fMetCAT
    IdGrammar("predicted", r"^.+\.trna[0-9]+-([A-Za-z]+)([ACGTUN]{3})$", {"aa": 1, "anticodon": 2}),
)


def parsed_field(ref_id: Column, field: str, grammars: Sequence[IdGrammar] = TRNA_GRAMMARS) -> Column:
    """A field of an id, or null; DNA letters in anticodons."""
    value = F.lit(None).cast("string")
    for g in reversed(grammars):
        own = F.regexp_extract(ref_id, g.pattern, g.groups[field]) if field in g.groups else F.lit(None).cast("string")
        value = F.when(ref_id.rlike(g.pattern), own).otherwise(value)
    return F.translate(value, "U", "T") if field == "anticodon" else value


def trna_dimensions(ref_ids: DataFrame, lineages: DataFrame | None = None, grammars: Sequence[IdGrammar] = TRNA_GRAMMARS) -> DataFrame:
    """Dimension table of distinct ``ref_id``: origin, species, aa, anticodon and phylum, null where unknown.

    ``lineages`` (species, phylum) names the phylum of a species; ids do not.
    """
    ids = ref_ids.select("ref_id").distinct()
    origin = F.coalesce(*[F.when(F.col("ref_id").rlike(g.pattern), g.origin) for g in grammars])
    out = ids.select("ref_id", origin.alias("origin"), *[parsed_field(F.col("ref_id"), f, grammars).alias(f) for f in FIELDS])
    if lineages is None:
        return out.withColumn("phylum", F.lit(None).cast("string"))
    return out.join(lineages.select("species", "phylum"), "species", "left").select("ref_id", "origin", *FIELDS, "phylum")
