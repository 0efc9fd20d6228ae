"""Reference panel tables: record selection, classes and taxon lookups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

# RNA gene biotypes and the host panel each belongs to.
BIOTYPE_PANELS = {
    "lncRNA": "hsa_otherRNA",
    "miRNA": "hsa_mature_miRNA",
    "misc_RNA": "hsa_otherRNA",
    "Mt_rRNA": "hsa_rRNA_all",
    "Mt_tRNA": "hsa_tRNA_all",
    "ribozyme": "hsa_otherRNA",
    "rRNA": "hsa_rRNA_all",
    "scaRNA": "hsa_otherRNA",
    "snoRNA": "hsa_otherRNA",
    "snRNA": "hsa_otherRNA",
    "sRNA": "hsa_otherRNA",
    "vault_RNA": "hsa_otherRNA",
}

# RNA family classes, the more specific before the more general.
FAMILY_CLASSES = (
    "rRNA", "tRNA", "miRNA", "snoRNA", "snRNA", "antisense", "ribozyme", "leader", "CRISPR", "riboswitch",
)


def of_species(panel: DataFrame, prefix: str = "hsa") -> DataFrame:
    """Records whose id starts with the species prefix."""
    return panel.filter(F.startswith("ref_id", F.lit(prefix)))


def of_other_species(panel: DataFrame, prefix: str = "hsa") -> DataFrame:
    """All other records, as whole records."""
    return panel.filter(~F.startswith("ref_id", F.lit(prefix)))


def with_biotype(panel: DataFrame) -> DataFrame:
    """Add ``biotype`` from the ``gene_biotype:`` field of the description."""
    return panel.withColumn("biotype", F.regexp_extract("description", r"gene_biotype:(\S+)", 1))


def consolidated(panel: DataFrame) -> DataFrame:
    """Add the host panel a record's biotype belongs to; other biotypes drop out."""
    lookup = F.create_map(*[F.lit(x) for pair in BIOTYPE_PANELS.items() for x in pair])
    return with_biotype(panel).withColumn("panel", F.try_element_at(lookup, F.col("biotype"))).filter("panel is not null")


def merged(origins: Mapping[str, DataFrame], unique_ids: bool = True) -> DataFrame:
    """Union of panels with their ``origin``; of equal ids the first origin by name stays."""
    out = None
    for origin, df in origins.items():
        part = df.select("ref_id", "description", "seq", F.lit(origin).alias("origin"))
        out = part if out is None else out.unionByName(part)
    if not unique_ids:
        return out
    first = F.min(F.struct("origin", "description", "seq")).alias("r")
    return out.groupBy("ref_id").agg(first).select("ref_id", "r.description", "r.seq", "r.origin")


def family_class(kind: Column) -> Column:
    """One of eleven classes from a family type such as ``Gene; snRNA; snoRNA; CD-box;``."""
    parts = F.transform(F.split(kind, ";"), lambda part: F.trim(part))
    label = F.lit("other")
    for name in reversed(FAMILY_CLASSES):
        label = F.when(F.array_contains(parts, name), name).otherwise(label)
    return label


def accession_taxa(used: DataFrame, taxa: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """accession, taxid, name for the accessions in use."""
    kept = taxa.join(used.select("accession").distinct(), "accession", "left_semi")
    return kept.join(taxonomy.select("taxid", "name"), "taxid", "left").select("accession", "taxid", "name")


def with_taxon(families: DataFrame, taxa: DataFrame) -> DataFrame:
    """Family records with their taxon name, ``unassigned`` where the accession is unknown."""
    return families.join(taxa.select("accession", F.col("name").alias("taxon")), "accession", "left").withColumn(
        "taxon", F.coalesce("taxon", F.lit("unassigned"))
    )


def manifest(panels: DataFrame, source: str, release: str) -> DataFrame:
    """One row per panel: source, release, records and bases."""
    return panels.groupBy("panel").agg(
        F.count("*").alias("records"), F.sum(F.length("seq")).alias("bases")
    ).select("panel", F.lit(source).alias("source"), F.lit(release).alias("release"), "records", "bases")
