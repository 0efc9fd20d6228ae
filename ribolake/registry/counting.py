"""Counts, summaries, panels, taxonomy and whole analyses."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.reference_ids import trna_dimensions
from ..operators import counts as ct
from ..operators import intervals as iv
from ..operators import panels as pl
from ..operators import taxonomy as tx
from ..operators.staging import stage
from ..plans import assembly, classification, novel, preprocessing
from . import alignment as ra
from . import intervals as ri
from . import reads as rr
from .catalog import query
from .inputs import ADAPTER

LCA_K = 12


# Counts at several levels.

_TRNA = """select sample, case grouping(ref_id,phylum,species,aa,anticodon) when 15 then 'feature' when 23 then 'phylum_class' when 27 then 'species'
  when 29 then 'amino_acid' when 30 then 'anticodon' else 'phylum_species' end as level,
 coalesce(ref_id,'') ref_id, coalesce(phylum,'') phylum, coalesce(species,'') species, coalesce(aa,'') aa, coalesce(anticodon,'') anticodon, cast(sum(n) as bigint) reads
 from dimhits join dim using (ref_id)
 group by grouping sets ((sample,ref_id),(sample,phylum),(sample,species),(sample,aa),(sample,anticodon),(sample,phylum,species))"""


@query("dim dimhits", _TRNA)
def trna_levels(t):
    counts = t("dimhits").withColumnRenamed("n", "reads")
    dims = t("dim").select("ref_id", "phylum", "species", "aa", "anticodon")
    return ct.level_counts(counts, dims, ct.TRNA_LEVELS).na.fill("")


_TRNA_IDS = """with d as (select ref_id, coalesce(phylum,'unassigned') phylum, coalesce(species,'unassigned') species, coalesce(aa,'unassigned') aa, coalesce(anticodon,'unassigned') anticodon
   from trna left join phyla using (species))
 select sample, case grouping(ref_id,phylum,species,aa,anticodon) when 15 then 'feature' when 23 then 'phylum_class' when 27 then 'species'
  when 29 then 'amino_acid' when 30 then 'anticodon' else 'phylum_species' end as level,
 coalesce(ref_id,'') ref_id, coalesce(phylum,'') phylum, coalesce(species,'') species, coalesce(aa,'') aa, coalesce(anticodon,'') anticodon, cast(sum(n) as bigint) reads
 from trnahits join d using (ref_id)
 group by grouping sets ((sample,ref_id),(sample,phylum),(sample,species),(sample,aa),(sample,anticodon),(sample,phylum,species))"""


@query("trna phyla trnahits", _TRNA_IDS)
def trna_levels_from_ids(t):
    """Dimensions read from the ids themselves; the SQL takes what the ids were made from."""
    counts = t("trnahits").withColumnRenamed("n", "reads")
    dims = trna_dimensions(counts, t("phyla")).select("ref_id", "phylum", "species", "aa", "anticodon")
    return ct.level_counts(counts, dims, ct.TRNA_LEVELS).na.fill("")


_RFAM = """with d as (select dim.*, coalesce(name,'unassigned') taxon from dim left join (select accession, name from acctax join tax using (taxid)) x using (accession))
 select sample, case grouping(family_class,taxon,family,accession) when 7 then 'class' when 11 then 'taxon' when 3 then 'class_taxon' when 13 then 'family' else 'accession' end as level,
 coalesce(family_class,'') family_class, coalesce(taxon,'') taxon, coalesce(family,'') family, coalesce(accession,'') accession, cast(sum(n) as bigint) reads
 from dimhits join d using (ref_id)
 group by grouping sets ((sample,family_class),(sample,taxon),(sample,family_class,taxon),(sample,family),(sample,accession))"""


def _accession_names(t):
    return pl.accession_taxa(t("dim"), t("acctax"), t("tax"))


@query("dim dimhits acctax tax", _RFAM)
def rfam_levels(t):
    dims = pl.with_taxon(t("dim"), _accession_names(t)).select("ref_id", "family_class", "taxon", "family", "accession")
    counts = t("dimhits").withColumnRenamed("n", "reads")
    return ct.level_counts(counts, dims, ct.FAMILY_LEVELS).na.fill("")


@query("dimhits", "select sample, cast(sum(n) as bigint) total from dimhits group by sample")
def count_total(t):
    return ct.count_total(t("dimhits"), value="n")


# Assembly branch: hits on the contigs, annotation from orders put onto them.

_CAN = """can as (select k.contig, (o.aid*37)%length(k.dna) s, least((o.aid*37)%length(k.dna)+20+o.aid%60, length(k.dna)) e, o.ftype, o.strand, cast(o.aid as string) name
  from an o join (select *, row_number() over (order by ctid)-1 rn, count(*) over () cnt from ct) k on k.rn = o.aid % k.cnt where length(k.dna)>0)"""


def _contig_annotation(t):
    """Features of ``an`` spread over the contigs."""
    from ..operators.ranking import ranked

    contigs = t("ct").select("contig", "ctid", F.length("dna").cast("bigint").alias("size"))
    numbered = ranked(contigs, ["ctid"], name="rn").withColumn("rn", F.col("rn") - 1)
    features = t("an").withColumn("rn", F.col("aid") % contigs.count())
    start = (F.col("aid") * 37) % F.col("size")
    return features.join(numbered.filter("size > 0"), "rn").select(
        numbered["contig"], start.alias("start"), F.least(start + 20 + F.col("aid") % 60, "size").alias("end"),
        "ftype", "strand", F.col("aid").cast("string").alias("name"),
    )


_PLACED_ON = f"""with {_CAN}, {ra.contigs_sql('g', 'assistant')}, @hits,
 bs as (select * from (select *, min(mm) over (partition by seq) m from h) x where mm=m),
 placed as (select seq, ref_id contig, pos s, pos+length(seq) e, strand, mm, count(*) over (partition by seq) n_hits, 1.0/count(*) over (partition by seq) weight from bs),
 ov as (select p.contig, p.s, p.e, p.strand, coalesce(b.name,'.') name, coalesce(b.ftype,'.') ftype,
   case when b.s is null then 0 else least(p.e,b.e)-greatest(p.s,b.s) end overlap, coalesce(b.s,-1) bs, coalesce(b.e,-1) be
   from (select distinct contig,s,e,strand from placed) p left join can b on b.contig=p.contig and b.s<p.e and p.s<b.e),
 best as (select contig,s,e,strand,name feature,ftype,overlap from (select *, row_number() over (partition by contig,s,e,strand order by overlap desc,bs,be,name,ftype) rk from ov) x where rk=1),
 annotated as (select * from placed join best using (contig,s,e,strand))"""
_PLACED = _PLACED_ON.replace("@hits", ra.hits_sql("h", "uniq", "g", 1))


def _quantified(t):
    hits = ra.aligned_to(t, ra.contigs(t, "assistant"), 1, "best_strata", counted=True)
    return assembly.feature_quantification(t("coll"), hits, _contig_annotation(t))


@query("an ct uniq", _PLACED + " select seq, contig, s start_pos, e end_pos, strand, n_hits, round(weight,6) weight from placed")
def weighted_bed(t):
    hits = ra.aligned_to(t, ra.contigs(t, "assistant"), 1, "best_strata", counted=True)
    rows = iv.sorted_intervals(assembly.weighted_intervals(hits).withColumnRenamed("seq", "name"))
    return rows.select(
        F.col("name").alias("seq"), "contig", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"), "strand", "n_hits", F.round("weight", 6).alias("weight")
    )


@query("an ct uniq", _PLACED + " select seq, contig, s start_pos, e end_pos, strand, feature, ftype, cast(overlap as bigint) overlap from annotated")
def best_annotation(t):
    return _quantified(t)["annotated"].select(
        "seq", "contig", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"), "strand", "feature", "ftype", "overlap"
    )


@query("an ct uniq coll", _PLACED + " select sample, feature, ftype, cast(sum(n) as bigint) raw, round(sum(cast(n*weight as double)),6) weighted from annotated join coll using (seq) group by all")
def feature_counts(t):
    return _quantified(t)["counts"].withColumn("weighted", F.round("weighted", 6))


@query("an ct uniq coll", _PLACED_ON.replace("@hits", ra.hits_sql("h", "uniq", "g", 2))
       + " select sample, feature, ftype, cast(sum(n) as bigint) raw, round(sum(cast(n*weight as double)),6) weighted from annotated join coll using (seq) group by all")
def assembly_branch(t):
    """The whole assembly branch, with up to two mismatches."""
    out = assembly.assembly_based(t("coll"), ra.contigs(t, "assistant"), _contig_annotation(t), v=2)
    return out["counts"].withColumn("weighted", F.round("weighted", 6))


@query("an ct uniq coll", _PLACED + " select sample, cast(e-s as bigint) as length, round(sum(cast(n*weight as double)),6) reads from annotated join coll using (seq) where e-s<=51 group by all")
def length_hist(t):
    return _quantified(t)["lengths"].withColumn("reads", F.round("reads", 6))


# Summaries of whole analyses.

_PRE = f"""with {rr.PASSED}, pu as (select distinct seq from passed), {ra.HOST_SPLIT.replace('@reads', 'pu').replace('@all', 'passed')}"""
_PRE_SUMMARY = """select sample, unnest(['input','trimmed','host','non_host']) category, unnest([(select count(*) from reads r where r.sample=x.sample), n, h, n-h]) as value from
 (select sample, count(*) n, count(host_reference) h from tagged group by sample) x"""


def _preprocessed(t):
    return preprocessing.preprocess(t("reads").select("sample", "read_id", "seq", "qual"), ra.host_references(t), ("panels", "transcripts"), ADAPTER)


@query("pn ct reads", f"{_PRE} {_PRE_SUMMARY}")
def preprocess_summary(t):
    return _preprocessed(t)["summary"]


_NON = f"""{_PRE}, nh as (select sample, seq, count(*) n from tagged where host_reference is null group by all), nu as (select distinct seq from nh),
 {ra.NONHOST_SQL.replace('@reads', 'nu')}, coll as (select * from nh)"""
_HST = f"""{_PRE}, hh as (select sample, seq, count(*) n from tagged where host_reference is not null group by all), hu as (select distinct seq from hh),
 {ra.refs_sql('g', *ra.HOST_ORDER)}, {ra.hits_sql('h', 'hu', 'g', 1)},
 fp as (select seq, min(list_position(['host_miRNA','host_tRNA','host_rRNA','host_other'], g.panel)) priority from h join g using (ref_id) group by seq),
 cl as (select sample, n, coalesce(priority,5) p from hh left join fp using (seq)),
 s as (select sample, sum(case when p=1 then n else 0 end) m, sum(case when p=2 then n else 0 end) t, sum(case when p=3 then n else 0 end) r, sum(case when p=4 then n else 0 end) o, sum(case when p=5 then n else 0 end) u from cl group by sample)"""
_HST_SUMMARY = """select sample, unnest(['trimmed','human_miRNA','human_tRNA','human_rRNA','human_otherRNA','remaining_after_miRNA','remaining_after_tRNA','remaining_after_rRNA','unknown_after_all']) category,
  unnest([cast(m+t+r+o+u as double),m,t,r,o,t+r+o+u,r+o+u,o+u,u]) as value from s"""


def _summaries(t):
    from ..operators.staging import stage

    pre = _preprocessed(t)
    samples = t("reads").select("sample").distinct()
    host = classification.host_specific(pre["host"], ra.panel(t, *ra.HOST_ORDER), ra.HOST_ORDER, samples)
    nonhost = classification.nonhost_specific(pre["non_host"], ra.panel(t, "tRNA", "miRNA", "rfam"), ra.panel(t, "rRNA"), samples, k=ra.RRNA_K)
    loci = novel.novel_ncrna(ri._alignments(t), ri._annotation(t))
    return {
        "preprocessing": stage(pre["summary"], "summary"), "host": stage(host["summary"], "summary"),
        "nonhost": stage(nonhost["summary"], "summary").drop("unit"), "novel": stage(loci["summary"], "summary"),
    }


@query("pn ct reads", f"{_HST} {_HST_SUMMARY}")
def host_workflow(t):
    pre = _preprocessed(t)
    return classification.host_specific(
        pre["host"], ra.panel(t, *ra.HOST_ORDER), ra.HOST_ORDER, t("reads").select("sample").distinct()
    )["summary"]


@query("pn ct reads", f"{_NON} {ra.NONHOST_SUMMARY_SQL}")
def nonhost_workflow(t):
    pre = _preprocessed(t)
    return classification.nonhost_specific(
        pre["non_host"], ra.panel(t, "tRNA", "miRNA", "rfam"), ra.panel(t, "rRNA"), t("reads").select("sample").distinct(), k=ra.RRNA_K
    )["summary"]


_NOVEL = f"{ri.NAMED}{ri.ANN}".strip()


@query("pn ct reads iv an", f"""{_NON}, {_HST[len(_PRE) + 2:]}, {_NOVEL},
 pre as ({_PRE_SUMMARY}), hs as ({_HST_SUMMARY}), ns as ({ra.NONHOST_SUMMARY_SQL}), tot as (select sample, count(*) n from iv group by sample)
 select 'preprocessing' source, sample, category, cast(value as varchar) as value from pre
 union all select 'host', sample, category, cast(value as varchar) from hs
 union all select 'nonhost', sample, category, cast(value as varchar) from ns
 union all select 'novel', sample, 'total_alignments', cast(n as varchar) from tot
 union all select 'novel', sample, 'novel_intergenic_candidates', cast((select count(*) from intergenic i where i.sample=t.sample) as varchar) from tot t
 union all select 'novel', sample, 'novel_antisense_candidates', cast((select count(*) from anti_rows i where i.sample=t.sample) as varchar) from tot t""")
def pipeline_summary(t):
    """The union of all four summaries."""
    return ct.pipeline_summary(_summaries(t))


# The branch of new loci from the reads on; every third candidate is in the hit table.
_BRANCH_IV = f"""with {_CAN}, {ra.contigs_sql('g', 'assistant')}, {ra.hits_sql('h', 'uniq', 'g', 1)},
 bs as (select * from (select *, min(mm) over (partition by seq) m from h) x where mm=m),
 iv as (select sample, ref_id contig, pos s, pos+length(bs.seq) e, bs.strand, read_id rid from clean join bs on clean.seq=bs.seq),
 feats as (select contig, s, e, ftype, strand, name aid from can)"""
_BRANCH = f"""{_BRANCH_IV}, {ri.MERGED.strip()},
 named as (select *, concat('cluster_',cast(row_number() over (partition by sample order by case strand when '+' then 0 else 1 end, contig, s) as varchar)) name from merged),
 kept as (select * from named where e-s between 18 and 250), supported as (select * from kept where support>=1){ri.ANN.replace("from an where ftype not in ('region','source')", "from feats")},
 found as (select sample,contig,s,e,strand,name,'intergenic' kind from intergenic union all select sample,contig,s,e,strand,name,'antisense' from anti_rows),
 cut as (select f.*, concat(f.contig,':',cast(f.s as varchar),'-',cast(f.e as varchar),'(',f.strand,')') fasta_id, substring(g.dna,cast(s+1 as int),cast(e-s as int)) w from found f join g on g.ref_id=f.contig)
 select sample, kind, name, fasta_id, case strand when '-' then reverse(translate(w,'ACGT','TGCA')) else w end seq from cut where s%3<>0"""


@query("an ct uniq clean", _BRANCH)
def novel_branch(t):
    """Alignment, clusters, candidates, sequences and exclusion of family hits."""
    found = stage(novel.novel_from_reads(t("clean"), ra.contigs(t, "assistant"), _contig_annotation(t), min_reads=1)["sequences"], "found")
    hits = found.filter("start % 3 = 0").select(F.col("fasta_id").alias("query"))
    return iv.without_family_hit(found, hits).select("sample", "kind", "name", "fasta_id", "seq")


# Panels.

@query("nc", "select ref_id, description, seq from nc where starts_with(ref_id,'hsa')")
def panel_species(t):
    return pl.of_species(t("nc")).select("ref_id", "description", "seq")


@query("nc", "select ref_id, description, seq from nc where not starts_with(ref_id,'hsa')")
def panel_other_species(t):
    return pl.of_other_species(t("nc")).select("ref_id", "description", "seq")


_BIOTYPE = "regexp_extract(description,'gene_biotype:([^ ]+)',1)"


@query("nc", f"select {_BIOTYPE} biotype, count(*) records, cast(sum(length(seq)) as bigint) bases from nc group by 1")
def panel_biotype(t):
    return pl.with_biotype(t("nc")).groupBy("biotype").agg(F.count("*").alias("records"), F.sum(F.length("seq")).alias("bases"))


_PANEL_CASE = f"""case when {_BIOTYPE} in ('Mt_tRNA') then 'hsa_tRNA_all' when {_BIOTYPE} in ('rRNA','Mt_rRNA') then 'hsa_rRNA_all'
 when {_BIOTYPE}='miRNA' then 'hsa_mature_miRNA' when {_BIOTYPE}='protein_coding' then null else 'hsa_otherRNA' end"""


@query("nc", f"select ref_id, {_BIOTYPE} biotype, {_PANEL_CASE} panel from nc where {_BIOTYPE}<>'protein_coding'")
def panel_consolidate(t):
    return pl.consolidated(t("nc")).select("ref_id", "biotype", "panel")


@query("nc pn", """with a as (select ref_id, description, seq, 'ncrna' origin from nc union all select ref_id, panel, dna, 'benchmark' from pn union all select ref_id, upper(description), seq, 'second' from nc)
 select ref_id, description, seq, origin from (select *, row_number() over (partition by ref_id order by origin, description, seq) rk from a) x where rk=1""")
def panel_merge(t):
    nc = t("nc").select("ref_id", "description", "seq")
    pn = t("pn").select("ref_id", F.col("panel").alias("description"), F.col("dna").alias("seq"))
    return pl.merged({"ncrna": nc, "benchmark": pn, "second": nc.withColumn("description", F.upper("description"))})


@query("nc", """select ref_id, kind, case when contains(kind,'rRNA') then 'rRNA' when contains(kind,'tRNA') then 'tRNA' when contains(kind,'miRNA') then 'miRNA'
 when contains(kind,'snoRNA') then 'snoRNA' when contains(kind,'snRNA') then 'snRNA' when contains(kind,'antisense') then 'antisense' when contains(kind,'ribozyme') then 'ribozyme'
 when contains(kind,'leader') then 'leader' when contains(kind,'CRISPR') then 'CRISPR' when contains(kind,'riboswitch') then 'riboswitch' else 'other' end family_class from nc""")
def family_class(t):
    return t("nc").select("ref_id", "kind", pl.family_class(F.col("kind")).alias("family_class"))


@query("dim acctax tax", "select accession, taxid, name from acctax join tax using (taxid) where accession in (select accession from dim)")
def accession_taxa(t):
    return _accession_names(t)


@query("pn", "select panel, 'benchmark' source, '1' release, count(*) records, cast(sum(length(dna)) as bigint) bases from pn group by panel")
def panel_manifest(t):
    return pl.manifest(t("pn").withColumnRenamed("dna", "seq"), "benchmark", "1")


# Taxonomy. The SQL finds the common ancestor depth by depth instead of by prefix.

_LCA = f"""with nodes as (select taxid, lineage, unnest(range(1,1+len(lineage))) d from tax),
 km as (select distinct least(k, reverse(translate(k,'ACGT','TGCA'))) km, taxid from (select substring(seq,cast(p as int),{LCA_K}) k, taxid from
   (select seq, taxid, unnest(range(1,length(seq)-{LCA_K - 2})) p from pntax) a) b where not contains(k,'N')),
 anc as (select km, taxid, d, lineage[d] node from km join nodes using (taxid)),
 tot as (select km, count(*) taxa from km group by km),
 lca as (select km, max(d) d from (select km, d, count(*) c, count(distinct node) nodes from anc group by km, d) x join tot using (km) where c=taxa and nodes=1 group by km),
 lcan as (select distinct anc.km, anc.node taxid from lca join anc using (km, d))"""
_CLASSIFY = _LCA + f""",
 rk as (select seq, least(k, reverse(translate(k,'ACGT','TGCA'))) km from (select seq, substring(seq,cast(p as int),{LCA_K}) k from
   (select seq, unnest(range(1,length(seq)-{LCA_K - 2})) p from uniq) a) b where not contains(k,'N')),
 hit as (select seq, taxid, count(*) hits from rk join lcan using (km) group by all),
 path as (select seq, hit.taxid, lineage[d] node from hit join nodes using (taxid)),
 score as (select p.seq, p.taxid, sum(h.hits) score from path p join hit h on h.seq=p.seq and h.taxid=p.node group by all),
 top as (select seq, taxid, score from (select *, max(score) over (partition by seq) m from score) x where score=m),
 tn as (select seq, score, lineage[d] node, d, count(*) c, (select count(*) from top t2 where t2.seq=top.seq) tops from top join nodes using (taxid) group by seq, score, lineage[d], d),
 win as (select seq, cast(max(score) as bigint) score, arg_max(node, d) taxid from tn where c=tops group by seq),
 cls as (select u.seq, coalesce(taxid,0) taxid, coalesce(score,0) score from uniq u left join win using (seq))"""


@query("tax pntax", _LCA + " select km kmer, taxid from lcan")
def kmer_lca_table(t):
    return tx.kmer_lca_table(t("pntax"), t("tax"), LCA_K).select("kmer", F.element_at("lineage", -1).alias("taxid"))


def _classified(t):
    return tx.classify(t("uniq"), tx.kmer_lca_table(t("pntax"), t("tax"), LCA_K), LCA_K)


@query("tax pntax uniq", _CLASSIFY + " select seq, taxid, score from cls")
def kmer_lca(t):
    return _classified(t)


@query("tax pntax uniq", _CLASSIFY + " select taxid, score, count(*) sequences, min(seq) first_seq, max(seq) last_seq from cls group by all")
def kmer_lca_scores(t):
    """The same assignment, counted by taxon and score."""
    return _classified(t).groupBy("taxid", "score").agg(
        F.count("*").alias("sequences"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq")
    )


# A k-mer is known by its minimizer: the m-mer, on either strand, with the smallest number after the mask.
TAXON_K, TAXON_M = 35, 31
_NUMBER = "('0b'||replace(replace(replace(replace(least(w, reverse(translate(w,'ACGT','TGCA'))),'A','00'),'C','01'),'G','10'),'T','11'))::bigint"
_MASK = tx.MINIMIZER_MASK % 4**TAXON_M


def _minimized(name: str, source: str) -> str:
    return f""" {name}_k as (select distinct k from (select substring(seq,cast(p as int),{TAXON_K}) k from
   (select seq, unnest(range(1,length(seq)-{TAXON_K - 2})) p from {source}) a) b where not contains(k,'N')),
 {name} as (select k, xor(min(xor({_NUMBER}, {_MASK}::bigint)), {_MASK}::bigint) km from
   (select k, substring(k,cast(unnest(range(1,{TAXON_K - TAXON_M + 2})) as int),{TAXON_M}) w from {name}_k) c group by k)"""


def _places(name: str, source: str, columns: str) -> str:
    return f""" {name} as (select {columns}, km from (select {columns}, substring(seq,cast(p as int),{TAXON_K}) k from
   (select *, unnest(range(1,length(seq)-{TAXON_K - 2})) p from {source}) a) b join {name}_min using (k))"""


_MINIMIZER_LCA = _LCA[: _LCA.index(" km as")] + _minimized("pk_min", "pntax") + "," + _places("pk", "pntax", "taxid") + """,
 km as (select distinct km, taxid from pk),
""" + _LCA[_LCA.index(" anc as"):]
_MINIMIZER_CLASSIFY = _MINIMIZER_LCA + "," + _minimized("rk_min", "uniq") + "," + _places("rk", "uniq", "seq") + "," + _CLASSIFY[
    _CLASSIFY.index(" hit as"):
]


@query("tax pntax", _MINIMIZER_LCA + " select km minimizer, taxid from lcan")
def minimizer_lca_table(t):
    return tx.minimizer_lca_table(t("pntax"), t("tax"), TAXON_K, TAXON_M).select("minimizer", F.element_at("lineage", -1).alias("taxid"))


@query("tax pntax uniq", _MINIMIZER_CLASSIFY + " select taxid, score, count(*) sequences, min(seq) first_seq, max(seq) last_seq from cls group by all")
def minimizer_lca(t):
    """Assignment with k-mers of 35 bases through a table of their minimizers, counted by taxon and score."""
    table = tx.minimizer_lca_table(t("pntax"), t("tax"), TAXON_K, TAXON_M)
    return tx.classify_by_minimizers(t("uniq"), table, TAXON_K, TAXON_M).groupBy("taxid", "score").agg(
        F.count("*").alias("sequences"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq")
    )


@query("tax pntax uniq coll", _CLASSIFY + """,
 direct as (select sample, taxid, sum(n) n from coll join cls using (seq) group by all),
 clade as (select sample, lineage[d] taxid, sum(n) c from direct join nodes using (taxid) group by all)
 select clade.sample, clade.taxid, tax.rank, tax.name, cast(c as bigint) clade_reads, cast(coalesce(direct.n,0) as bigint) direct_reads from clade join tax using (taxid) left join direct on direct.sample=clade.sample and direct.taxid=clade.taxid
 union all select sample, 0, 'unclassified', 'unclassified', cast(n as bigint), cast(n as bigint) from direct where taxid=0""")
def clade_report(t):
    assigned = tx.assign(t("coll"), tx.kmer_lca_table(t("pntax"), t("tax"), LCA_K), LCA_K)
    return tx.clade_report(assigned, t("tax"))
