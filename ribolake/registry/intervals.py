"""Interval queries: alignments and annotation from lineitem and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.alignment import is_mapped, strand_of
from ..operators import intervals as iv
from ..sources.gff import gff_intervals, gff_lines, gff_wide
from ..sources.sam import sam_records
from ..operators.staging import stage
from .catalog import query

GAP = 10


def _alignments(t):
    return t("iv").select("sample", "contig", F.col("s").alias("start"), F.col("e").alias("end"), F.col("rid").alias("name"), "strand")


def _pooled(t):
    return _alignments(t).drop("sample")


def _annotation(t):
    """GFF intervals without the container types."""
    return t("an").filter(~F.col("ftype").isin("region", "source")).select(
        "contig", F.col("s").alias("start"), F.col("e").alias("end"), "ftype", F.col("aid").cast("string").alias("name"), "strand"
    )


def _cds(t):
    return _annotation(t).filter(F.col("ftype") == "CDS")


def _clusters(t):
    """Named, supported clusters of each sample."""
    return stage(iv.novel_clusters(_alignments(t), GAP), "clusters")


# SQL pieces: gaps and islands per sample, contig and strand; naming; support.
MERGED = """
 marked as (select *, case when s > max(e) over (partition by sample,contig,strand order by s,e,rid rows between unbounded preceding and 1 preceding) + 10
    then 1 else 0 end br from iv),
 islands as (select *, sum(br) over (partition by sample,contig,strand order by s,e,rid rows unbounded preceding) g from marked),
 merged as (select sample,contig,strand,min(s) s,max(e) e,count(*) support from islands group by sample,contig,strand,g)"""
NAMED = MERGED + """,
 named as (select *, concat('cluster_',cast(row_number() over (partition by sample order by case strand when '+' then 0 else 1 end, contig, s) as varchar)) name from merged),
 kept as (select * from named where e-s between 18 and 250),
 supported as (select * from kept where support>=10)"""
ANN = """,
 ann as (select * from an where ftype not in ('region','source')),
 cds as (select * from ann where ftype='CDS'),
 intergenic as (select * from supported c where not exists (select 1 from ann b where b.contig=c.contig and b.strand=c.strand and b.s<c.e and c.s<b.e)),
 anti_rows as (select distinct c.sample,c.contig,c.s,c.e,c.name,c.strand from supported c join cds b
   on b.contig=c.contig and b.s<c.e and c.s<b.e and ((b.strand='+' and c.strand='-') or (b.strand='-' and c.strand='+')))"""

_CLUSTER = "sample, contig, strand, s as start_pos, e as end_pos"


def _pos(df):
    """``start`` and ``end`` are reserved words in SQL."""
    return df.withColumnsRenamed({"start": "start_pos", "end": "end_pos", "b_start": "b_start_pos", "b_end": "b_end_pos"})


@query("iv", f"with {MERGED} select {_CLUSTER}, cast(support as bigint) support from merged")
def merge_intervals(t):
    return _pos(iv.merge_intervals(_alignments(t), ("sample", *iv.STRANDED), GAP))


@query("iv", f"with {NAMED} select {_CLUSTER}, name from named")
def cluster_ids(t):
    merged = iv.merge_intervals(_alignments(t), ("sample", *iv.STRANDED), GAP)
    return _pos(iv.name_clusters(merged, by="sample").drop("support"))


@query("iv", f"with {MERGED} select {_CLUSTER} from merged where e-s between 18 and 250")
def cluster_len(t):
    merged = iv.merge_intervals(_alignments(t), ("sample", *iv.STRANDED), GAP)
    return _pos(iv.length_between(merged, 18, 250).drop("support"))


@query("iv an", """
 select a.contig, a.strand, a.s as start_pos, a.e as end_pos, a.aid, count(b.rid) as overlaps
 from an a left join iv b on a.contig=b.contig and a.strand=b.strand and b.s<a.e and a.s<b.e
 group by all""")
def cluster_support(t):
    """Strand-specific overlap count; intervals without any keep a zero row."""
    features = t("an").select("contig", "strand", F.col("s").alias("start"), F.col("e").alias("end"), "aid")
    return _pos(iv.overlap_count(features, _pooled(t), iv.STRANDED))


@query("iv", f"with {NAMED} select {_CLUSTER}, name, support from supported")
def cluster_supported(t):
    return _pos(_clusters(t))


@query("iv", f"with {NAMED} select sample, contig, count(*) clusters, cast(sum(support) as bigint) reads from supported group by sample, contig")
def novel_clusters(t):
    return _clusters(t).groupBy("sample", "contig").agg(
        F.count("*").alias("clusters"), F.sum("support").alias("reads")
    )


@query("iv an", """
 with ann as (select contig, s, e, ftype, strand, cast(aid as string) name from an where ftype not in ('region','source'))
 select a.contig, a.s as start_pos, a.e as end_pos, a.rid as name, a.strand,
   coalesce(b.s,-1) b_start_pos, coalesce(b.e,-1) b_end_pos, coalesce(b.ftype,'.') b_ftype, coalesce(b.name,'.') b_name, coalesce(b.strand,'.') b_strand,
   cast(case when b.s is null then 0 else least(a.e,b.e)-greatest(a.s,b.s) end as bigint) overlap
 from iv a left join ann b on a.contig=b.contig and b.s<a.e and a.s<b.e""")
def interval_wao(t):
    return _pos(iv.overlap_left_outer(_pooled(t), _annotation(t)))


@query("iv an", f"with {NAMED}{ANN} select {_CLUSTER}, name, support from intergenic")
def intergenic(t):
    return _pos(iv.intergenic(_clusters(t), _annotation(t)))


@query("iv an", f"""with {NAMED}{ANN} select c.sample,c.contig,c.strand,c.s as start_pos,c.e as end_pos,c.name,c.support,
   b.s as b_start_pos,b.e as b_end_pos,b.ftype b_ftype,cast(b.aid as string) b_name,b.strand b_strand, least(c.e,b.e)-greatest(c.s,b.s) overlap
 from supported c join cds b on b.contig=c.contig and b.s<c.e and c.s<b.e and ((b.strand='+' and c.strand='-') or (b.strand='-' and c.strand='+'))""")
def antisense_pairs(t):
    return _pos(iv.antisense_pairs(_clusters(t), _cds(t)))


@query("iv an", f"with {NAMED}{ANN} select {_CLUSTER}, name from anti_rows")
def antisense(t):
    return _pos(iv.antisense(_clusters(t), _cds(t)))


_CANDIDATES = f"""select {_CLUSTER}, name, 'intergenic' kind from intergenic
 union all select {_CLUSTER}, name, 'antisense' kind from anti_rows"""


def _candidates(t):
    clusters = _clusters(t)
    return iv.candidates(iv.intergenic(clusters, _annotation(t)), iv.antisense(clusters, _cds(t)))


@query("iv an", f"with {NAMED}{ANN} {_CANDIDATES}")
def candidates(t):
    return _pos(_candidates(t))


@query("iv an", f"""with {NAMED}{ANN}, cand as ({_CANDIDATES}),
 ids as (select *, concat(contig,':',cast(start_pos as varchar),'-',cast(end_pos as varchar),'(',strand,')') fasta_id from cand),
 hit as (select distinct concat(contig,':',cast(s as varchar),'-',cast(e as varchar),'(',strand,')') fasta_id from supported where support%3=0)
 select * from ids where fasta_id not in (select fasta_id from hit)""")
def no_family_hit(t):
    """A third of the clusters plays the external hit table."""
    sequences = _candidates(t).withColumn("fasta_id", F.format_string("%s:%d-%d(%s)", "contig", "start", "end", "strand"))
    hits = _clusters(t).filter("support % 3 = 0").select(F.format_string("%s:%d-%d(%s)", "contig", "start", "end", "strand").alias("query"))
    return _pos(iv.without_family_hit(sequences, hits))


@query("iv", """
 select row_number() over (order by contig, s, e, strand, sample, rid) rank, sample, contig, s as start_pos, e as end_pos, strand, rid as name from iv""")
def sort_bed(t):
    """Coordinate order, shown as a row number over the whole table."""
    from ..operators.ranking import ranked

    return _pos(ranked(_alignments(t), ["contig", "start", "end", "strand", "sample", "name"]))


_GFF = """
 with f as (select string_split(line, chr(9)) p from gff where line <> '' and line not like '#%'),
 g as (select p[1] contig, greatest(cast(p[4] as bigint)-1,0) a, cast(p[5] as bigint) b, p[3] ftype, p[7] strand, p from f where len(p)>=8)"""


@query("gff", _GFF + " select contig, least(a,b) start_pos, greatest(a,b) end_pos, ftype, strand from g where ftype not in ('region','source')")
def gff_to_bed(t):
    return _pos(gff_intervals(gff_lines(t("gff").withColumnRenamed("line", "value"))).drop("score"))


@query("gff", _GFF + """ select contig, a start_pos, b end_pos, regexp_extract(p[9],'ID=([^;]*)',1) id, p[6] score, strand, p[2] source, ftype, p[8] phase, p[9] attributes from g""")
def gff_to_bed_full(t):
    return _pos(gff_wide(gff_lines(t("gff").withColumnRenamed("line", "value"))))


@query("gff", _GFF + " select contig, least(a,b) start_pos, greatest(a,b) end_pos, strand from g where ftype='CDS'")
def cds_subset(t):
    rows = gff_intervals(gff_lines(t("gff").withColumnRenamed("line", "value")))
    return _pos(rows.filter("ftype = 'CDS'").drop("ftype", "score"))


_SAM = """
 with f as (select string_split(line, chr(9)) p from sam where line not like '@%'),
 g as (select p[1] qname, cast(p[2] as int) flag, p[3] rname, cast(p[4] as bigint) pos, p[10] seq from f where len(p)>=11)"""


@query("sam", _SAM + " select rname contig, pos-1 start_pos, cast(pos-1+length(seq) as bigint) end_pos, qname as name, case when flag&16<>0 then '-' else '+' end strand from g where flag&4=0")
def sam_to_bed(t):
    records = sam_records(t("sam").withColumnRenamed("line", "value"))
    return _pos(iv.alignments_to_intervals(records.select("qname", "flag", "rname", "pos", "seq")))


@query("sam", _SAM + " select flag, case when flag&16<>0 then '-' else '+' end strand, flag&4=0 mapped, count(*) records from g group by all")
def sam_flags(t):
    records = sam_records(t("sam").withColumnRenamed("line", "value"))
    return records.groupBy("flag", strand_of(F.col("flag")).alias("strand"), is_mapped(F.col("flag")).alias("mapped")).agg(
        F.count("*").alias("records")
    )


@query("iv an", f"""with {NAMED}{ANN},
 total as (select sample, count(*) n from iv group by sample)
 select sample, 'total_alignments' category, n as value from total
 union all select sample, 'novel_intergenic_candidates', (select count(*) from intergenic i where i.sample=t.sample) from total t
 union all select sample, 'novel_antisense_candidates', (select count(*) from anti_rows i where i.sample=t.sample) from total t""")
def novel_summary(t):
    from ..plans.novel import novel_ncrna

    return novel_ncrna(_alignments(t), _annotation(t))["summary"]
