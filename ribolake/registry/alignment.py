"""Mismatch joins of reads from whole documents to panels and contigs, and cascades."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import align as al
from ..operators import cascade as cs
from ..operators import counts as ct
from ..operators import edits as ed
from ..operators import intervals as iv
from ..operators import seedstore as ss
from ..operators import taxonomy as tx
from ..operators.staging import staging_folder
from ..sources import sinks
from ..sources.fasta_tiles import read_fasta_tiles
from .catalog import query

HOST_ORDER = ("host_miRNA", "host_tRNA", "host_rRNA", "host_other")
RRNA_K = 12


def panel(t, *names):
    rows = t("pn").filter(F.col("panel").isin(*names))
    return rows.select("ref_id", "panel", F.col("dna").alias("seq"))


# Every contig belongs to one of the two references.
ROLES = {"user": ("user", "system"), "assistant": ("assistant",)}


def contigs(t, role):
    return t("ct").filter(F.col("role").isin(*ROLES[role])).select(F.col("contig").alias("ref_id"), F.col("dna").alias("seq"))


def aligned_to(t, refs, v=1, report="all", min_length=15, reads=None, counted=False):
    reads = t("uniq") if reads is None else reads
    return al.mismatch_join(reads, al.build_index(refs, min_length=min_length), v, report, min_length, counted=counted)


def hits_sql(name: str, reads: str, refs: str, v: int, shortest: int = 15) -> str:
    """CTEs for all hits within ``v`` of ``reads``(seq) on ``refs``(ref_id, dna).

    Cut into v + 1 equal pieces a read has one exact piece; the first q bases of each
    piece are looked up, q as long as the read allows, up to 10.
    """
    lengths = sorted({min(10, n // (v + 1)) for n in range(shortest, 80)})
    return f"""
 {name}_o as (select ref_id, '+' strand, dna o, length(dna) n from {refs} union all
   select ref_id, '-', reverse(translate(dna,'ACGT','TGCA')), length(dna) from {refs}),
 {name}_i as materialized (select ref_id, strand, o, n, q, p, substring(o,cast(p+1 as int),cast(q as int)) km from
   (select ref_id, strand, o, n, q, unnest(range(0,n-q+1)) p from {name}_o, (select unnest({lengths}) q) x where n>=q) y),
 {name}_r as (select seq, n, q, unnest(range(0,{v + 1}))*(n//{v + 1}) f from (select seq, length(seq) n, least(10,length(seq)//{v + 1}) q from {reads}) x),
 {name}_c as (select distinct r.seq, i.ref_id, i.strand, i.n rn, i.p-r.f w, substring(i.o,cast(i.p-r.f+1 as int),cast(r.n as int)) win
   from {name}_r r join {name}_i i on i.q=r.q and i.km=substring(r.seq,cast(r.f+1 as int),cast(r.q as int))
   where i.p>=r.f and i.p-r.f+r.n<=i.n),
 {name} as (select seq, ref_id, case strand when '+' then w else rn-w-length(seq) end pos, strand, cast(mm as int) mm from
   (select *, case when length(win)=length(seq) then hamming(seq,win) else 99 end mm from {name}_c where not contains(win,'N')) z where mm<={v})"""


def best_sql(hits: str) -> str:
    return f"""select seq, ref_id, pos, strand, mm from (select *, row_number() over (partition by seq order by mm, ref_id, pos, strand) rk from {hits}) b where rk=1"""


def refs_sql(name: str, *panels: str) -> str:
    quoted = ",".join(f"'{p}'" for p in panels)
    return f"{name} as (select ref_id, panel, dna from pn where panel in ({quoted}))"


def contigs_sql(name: str, role: str) -> str:
    quoted = ",".join(f"'{r}'" for r in ROLES[role])
    return f"{name} as (select contig ref_id, dna from ct where role in ({quoted}))"


@query("ct uniq", f"with {contigs_sql('g', 'user')}, {hits_sql('h', 'uniq', 'g', 1)} {best_sql('h')}")
def host_align(t):
    return aligned_to(t, contigs(t, "user"), 1, "best1")


@query("pn uniq", f"with {refs_sql('g', *HOST_ORDER)}, {hits_sql('h', 'uniq', 'g', 1)} select seq, ref_id, pos, strand, mm from h")
def align_all(t):
    return aligned_to(t, panel(t, *HOST_ORDER), 1, "all").select(*al.HIT_COLUMNS)


@query("pn coll", f"""with {refs_sql('g', 'tRNA')}, u as (select distinct seq from coll), {hits_sql('h', 'u', 'g', 1)}, b as ({best_sql('h')})
 select c.sample, c.seq, c.n, b.ref_id, b.pos, b.strand, b.mm from coll c join b using (seq)""")
def trna_align(t):
    reads = t("coll")
    hits = aligned_to(t, panel(t, "tRNA"), 1, "best1", reads=reads)
    return reads.join(hits, "seq").select("sample", "seq", "n", "ref_id", "pos", "strand", "mm")


@query("pn uniq", f"""with {refs_sql('g', 'miRNA')}, u as (select seq from uniq where length(seq) between 18 and 26), {hits_sql('h', 'u', 'g', 0, 18)} {best_sql('h')}""")
def mirna_exact(t):
    short = t("uniq").filter(F.length("seq").between(18, 26))
    return aligned_to(t, panel(t, "miRNA"), 0, "best1", 18, short).select(*al.HIT_COLUMNS)


@query("pn uniq", f"with {refs_sql('g', 'rfam')}, {hits_sql('h', 'uniq', 'g', 1)} {best_sql('h')}")
def rfam_align(t):
    return aligned_to(t, panel(t, "rfam"), 1, "best1").select(*al.HIT_COLUMNS)


_STRATA = "select seq, ref_id, pos, strand, mm from (select *, min(mm) over (partition by seq) m from h) x where mm=m"


@query("ct uniq", f"with {contigs_sql('g', 'assistant')}, {hits_sql('h', 'uniq', 'g', 1)} {_STRATA}")
def strata_align(t):
    return aligned_to(t, contigs(t, "assistant"), 1, "best_strata")


@query("ct uniq", f"with {contigs_sql('g', 'assistant')}, {hits_sql('h', 'uniq', 'g', 2)} {_STRATA}")
def assembly_align(t):
    return aligned_to(t, contigs(t, "assistant"), 2, "best_strata")


def edits_sql(name: str, reads: str, refs: str, tiers) -> str:
    """CTEs for the edit-distance alignments of ``reads``(seq) on ``refs``(ref_id, dna), before best strata.

    Pieces of a read are looked up by their first bases; windows around each answer are
    compared whole.
    """
    limits = [*[t[0] for t in tiers[1:]], 10_000]
    tier = "case " + " ".join(f"when length(seq)>={a} and length(seq)<{b} then {e}" for (a, e), b in zip(tiers, limits)) + " end"
    return f"""
 {name}_o as (select ref_id, '+' strand, dna o, length(dna) n from {refs} union all
   select ref_id, '-', reverse(translate(dna,'ACGT','TGCA')), length(dna) from {refs}),
 {name}_i as materialized (select ref_id, strand, p, substring(o,cast(p+1 as int),10) km from
   (select ref_id, strand, o, unnest(range(0,n-9)) p from {name}_o where n>=10) y),
 {name}_r as (select seq, length(seq) n, e, unnest(range(0,e+1))*(length(seq)//(e+1)) f from (select seq, {tier} e from {reads}) x where e is not null),
 {name}_c as (select distinct r.seq, r.n, r.e, i.ref_id, i.strand, i.p-r.f w from {name}_r r join {name}_i i on i.km=substring(r.seq,cast(r.f+1 as int),10)),
 {name}_w as (select seq, n, e, ref_id, strand, w, sh, unnest(range(-e,e+1)) th from (select *, unnest(range(-e,e+1)) sh from {name}_c) x),
 {name}_v as (select distinct seq, ln, e, c.ref_id, c.strand, o.n rn, w+sh a, w+ln+th b, substring(o.o,cast(w+sh+1 as int),cast(ln+th-sh as int)) win
   from (select seq, n ln, e, ref_id, strand, w, sh, th from {name}_w where abs(sh)+abs(th)<=e) c join {name}_o o on o.ref_id=c.ref_id and o.strand=c.strand
   where w+sh>=0 and w+ln+th<=o.n),
 {name}_l as (select *, case strand when '+' then a else rn-b end pos, case strand when '+' then b else rn-a end fin, levenshtein(seq,win) d from {name}_v where not contains(win,'N')),
 {name}_s as (select seq, e, ref_id, strand, pos, fin, d from (select *, row_number() over (partition by seq, ref_id, strand, pos order by d, abs(fin-pos-ln), fin) rk from {name}_l where d<=e) x where rk=1),
 {name} as (select seq, ref_id, strand, pos, fin, d from {name}_s x where not exists (select 1 from {name}_s y where y.seq=x.seq and y.ref_id=x.ref_id and y.strand=x.strand
   and abs(y.pos-x.pos)<=2*x.e and (y.d<x.d or (y.d=x.d and y.pos<x.pos))))"""


@query("ct uniq", f"""with {contigs_sql('g', 'assistant')}, {edits_sql('h', 'uniq', 'g', ed.TIERS)}
 select seq, ref_id, cast(pos as bigint) pos, cast(fin as bigint) end_pos, strand, cast(d as int) edits from (select *, min(d) over (partition by seq) m from h) x where d=m""")
def assembly_align_indels(t):
    """Substitutions, insertions and deletions: one edit from 20 bases on, two from 33 on."""
    reads = t("uniq").filter(F.length("seq") >= ed.TIERS[0][0])
    index = al.build_index(contigs(t, "assistant"), k=10)
    return ed.edit_join(reads, index, ed.TIERS, "best_strata").withColumnRenamed("end", "end_pos")


@query("pn uniq", f"with {refs_sql('g', *HOST_ORDER)}, {hits_sql('h', 'uniq', 'g', 1)} select seq, ref_id, pos, strand, mm from h")
def seed_table_kept(t):
    """The index is kept on storage, forgotten and loaded again before reads are aligned."""
    reads = t("uniq")
    spark = reads.sparkSession
    name = f"kept_{uuid.uuid4().hex}"
    folder = f"{staging_folder(spark)}/index-{name}"
    ss.save_index(al.build_index(panel(t, *HOST_ORDER)), name, folder, "r1", 8)
    ss.drop_index(spark, name)
    return al.mismatch_join(reads, ss.load_index(spark, folder), 1, "all", 15).select(*al.HIT_COLUMNS)


_SPLIT = f"with {refs_sql('g', 'tRNA')}, u as (select distinct seq from clean), {hits_sql('h', 'u', 'g', 1)}"


@query("pn clean", _SPLIT + " select sample, read_id, seq from clean where seq in (select seq from h)")
def split_al(t):
    return al.aligned(t("clean"), aligned_to(t, panel(t, "tRNA"))).select("sample", "read_id", "seq")


@query("pn clean", _SPLIT + " select sample, read_id, seq from clean where seq not in (select seq from h)")
def split_un(t):
    return al.unaligned(t("clean"), aligned_to(t, panel(t, "tRNA"))).select("sample", "read_id", "seq")


def host_references(t):
    """Host panels first, then host transcripts."""
    return panel(t, *HOST_ORDER).withColumn("panel", F.lit("panels")).unionByName(
        contigs(t, "user").withColumn("panel", F.lit("transcripts"))
    )


def host_tagged(t, reads):
    refs = host_references(t)
    hits = cs.with_priority(aligned_to(t, refs, reads=reads), ("panels", "transcripts"))
    return cs.host_split(reads, hits)


HOST_SPLIT = f"""{refs_sql('g1', *HOST_ORDER)}, {contigs_sql('g2', 'user')},
 {hits_sql('h1', '@reads', 'g1', 1)}, {hits_sql('h2', '@reads', 'g2', 1)},
 tagged as (select r.*, case when seq in (select seq from h1) then 1 when seq in (select seq from h2) then 2 end host_reference from @all r)"""


@query("pn ct clean uniq", f"with {HOST_SPLIT.replace('@reads', 'uniq').replace('@all', 'clean')} select sample, read_id, coalesce(host_reference,0) host_reference, host_reference is not null host from tagged")
def host_split(t):
    return host_tagged(t, t("clean")).select("sample", "read_id", F.coalesce("host_reference", F.lit(0)).alias("host_reference"), "host")


def host_hits(t):
    refs = panel(t, *HOST_ORDER)
    return cs.with_priority(aligned_to(t, refs), HOST_ORDER)


_HOST = f"""with {refs_sql('g', *HOST_ORDER)}, {hits_sql('h', 'uniq', 'g', 1)},
 hp as (select h.*, g.panel, list_position(['host_miRNA','host_tRNA','host_rRNA','host_other'], g.panel) priority from h join g using (ref_id)),
 fp as (select seq, min(priority) priority from hp group by seq),
 hc as (select hp.* from hp join fp using (seq, priority)),
 cl as (select c.sample, c.seq, c.n, case priority when 1 then 'miRNA' when 2 then 'tRNA' when 3 then 'rRNA' when 4 then 'otherRNA' else 'unknown' end rna_class
   from coll c left join fp using (seq))"""


@query("pn coll uniq", _HOST + " select sample, rna_class, count(*) sequences, cast(sum(n) as bigint) reads from cl group by all")
def host_cascade(t):
    return cs.host_classes(t("coll"), host_hits(t)).groupBy("sample", "rna_class").agg(
        F.count("*").alias("sequences"), F.sum("n").alias("reads")
    )


@query("pn coll uniq", _HOST + """, w as (select seq, ref_id, 1.0/count(*) over (partition by seq) w from hc)
 select sample, ref_id, round(sum(cast(n*w as double)),6) reads from coll join w using (seq) group by all""")
def fractional_counts(t):
    counts = ct.fractional_counts(t("coll"), cs.hits_of_first_class(host_hits(t)))
    return counts.select("sample", "ref_id", F.round("reads", 6).alias("reads"))


@query("pn coll uniq", _HOST + """,
 s as (select sample, sum(case rna_class when 'miRNA' then n else 0 end) m, sum(case rna_class when 'tRNA' then n else 0 end) t,
  sum(case rna_class when 'rRNA' then n else 0 end) r, sum(case rna_class when 'otherRNA' then n else 0 end) o, sum(case rna_class when 'unknown' then n else 0 end) u from cl group by sample)
 select sample, category, cast(v as double) as value from (select sample, unnest(['trimmed','human_miRNA','human_tRNA','human_rRNA','human_otherRNA','remaining_after_miRNA','remaining_after_tRNA','remaining_after_rRNA','unknown_after_all']) category,
  unnest([m+t+r+o+u,m,t,r,o,t+r+o+u,r+o+u,o+u,u]) v from s) x""")
def host_summary(t):
    reads = t("coll")
    return cs.host_summary(cs.host_classes(reads, host_hits(t)), reads)


RRNA_SQL = f"""
 rk as (select distinct substring(o,cast(p+1 as int),{RRNA_K}) km from (select o, unnest(range(0,length(o)-{RRNA_K - 1})) p from
   (select dna o from pn where panel='rRNA' union all select reverse(translate(dna,'ACGT','TGCA')) from pn where panel='rRNA') a) b),
 sk as (select seq, substring(seq,cast(p as int),{RRNA_K}) km from (select seq, unnest(range(1,length(seq)-{RRNA_K - 2})) p from @reads where length(seq)>={RRNA_K}) a),
 sf as (select seq, count(*) f from sk where km in (select km from rk where not contains(km,'N')) group by seq),
 screen as (select u.seq, round(case when length(u.seq)>={RRNA_K} then coalesce(f,0)/(length(u.seq)-{RRNA_K - 1}) else 0 end,6) share from @reads u left join sf using (seq))"""


def screened(t, reads=None):
    return tx.rrna_screen(t("uniq") if reads is None else reads, panel(t, "rRNA"), RRNA_K)


@query("pn uniq", f"with {RRNA_SQL.replace('@reads', 'uniq')} select seq, share, share>=0.5 is_rrna from screen")
def rrna_screen(t):
    return screened(t)


@query("pn uniq", f"with {RRNA_SQL.replace('@reads', 'uniq')} select length(seq) size, share, count(*) sequences, min(seq) first_seq, max(seq) last_seq from screen group by all")
def rrna_screen_shares(t):
    """The same screen, counted by read length and share."""
    return screened(t).groupBy(F.length("seq").alias("size"), "share").agg(
        F.count("*").alias("sequences"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq")
    )


def nonhost_hits(t, reads=None):
    refs = panel(t, "tRNA", "miRNA", "rfam")
    return aligned_to(t, refs, reads=reads)


def nonhost_classified(t, reads=None):
    reads = t("uniq") if reads is None else reads
    return cs.nonhost_classes(reads, nonhost_hits(t, reads), screened(t, reads).filter("is_rrna"))


NONHOST_SQL = f"""{refs_sql('gt', 'tRNA')}, {refs_sql('gm', 'miRNA')}, {refs_sql('gr', 'rfam')}, {RRNA_SQL},
 s1 as (select seq from screen where share<0.5),
 {hits_sql('ht', 's1', 'gt', 1)}, bt as ({best_sql('ht')}),
 s2 as (select seq from s1 where seq not in (select seq from bt)),
 sm as (select seq from s2 where length(seq) between 18 and 26),
 {hits_sql('hm', 'sm', 'gm', 0, 18)}, bm as ({best_sql('hm')}),
 s3 as (select seq from sm where seq not in (select seq from bm) union all select seq from s2 where length(seq)>=27),
 {hits_sql('hr', 's3', 'gr', 1)}, br as ({best_sql('hr')}),
 classes as (select seq, 'rRNA' rna_class, null ref_id, null pos, null strand, null mm from screen where share>=0.5
  union all select seq, 'tRNA', ref_id, pos, strand, mm from bt
  union all select seq, 'miRNA', ref_id, pos, strand, mm from bm
  union all select seq, 'rfam', ref_id, pos, strand, mm from br
  union all select seq, 'too_short', null, null, null, null from s2 where length(seq)<18
  union all select seq, 'unknown', null, null, null, null from s3 where seq not in (select seq from br))"""


@query("pn uniq", f"with {NONHOST_SQL.replace('@reads', 'uniq')} select seq, rna_class, coalesce(ref_id,'') ref_id, cast(coalesce(pos,-1) as bigint) pos, coalesce(strand,'') strand, cast(coalesce(mm,-1) as int) mm from classes")
def nonhost_cascade(t):
    """Class and hit of each sequence; no hit shows as empty and -1."""
    return nonhost_classified(t).na.fill("", ["ref_id", "strand"]).na.fill(-1, ["pos", "mm"])


@query("pn uniq", f"with {NONHOST_SQL.replace('@reads', 'uniq')} select rna_class, coalesce(ref_id,'') ref_id, coalesce(strand,'') strand, cast(coalesce(mm,-1) as int) mm, count(*) sequences, cast(sum(coalesce(pos,-1)) as bigint) positions, min(seq) first_seq, max(seq) last_seq from classes group by all")
def nonhost_cascade_classes(t):
    """The same cascade, counted by class and reference."""
    rows = nonhost_classified(t).na.fill("", ["ref_id", "strand"]).na.fill(-1, ["pos", "mm"])
    return rows.groupBy("rna_class", "ref_id", "strand", "mm").agg(
        F.count("*").alias("sequences"), F.sum("pos").alias("positions"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq")
    )


@query("pn coll uniq", f"with {NONHOST_SQL.replace('@reads', 'uniq')} select sample, ref_id, cast(sum(n) as bigint) reads from coll join classes using (seq) where rna_class='miRNA' group by all")
def mirna_counts(t):
    return ct.reference_counts(t("coll"), nonhost_classified(t).filter("rna_class = 'miRNA'"))


NONHOST_SUMMARY_SQL = """
 select sample, category, cast(coalesce(v,0) as double) as value, unit from (select sample,
  unnest(['rrna_reads','non_rrna_collapsed_sequences','trna_like_reads','mirna_like_reads','rfam_classified_reads','unknown_sequences','too_short_reads']) category,
  unnest([sum(n) filter (rna_class='rRNA'), count(*) filter (rna_class<>'rRNA'), sum(n) filter (rna_class='tRNA'), sum(n) filter (rna_class='miRNA'),
   sum(n) filter (rna_class='rfam'), count(*) filter (rna_class='unknown'), sum(n) filter (rna_class='too_short')]) v,
  unnest(['reads','sequences','reads','reads','reads','sequences','reads']) unit
  from coll join classes using (seq) group by sample) x"""


@query("pn coll uniq", f"with {NONHOST_SQL.replace('@reads', 'uniq')}" + NONHOST_SUMMARY_SQL)
def nonhost_summary(t):
    reads = t("coll")
    return cs.nonhost_summary(reads, nonhost_classified(t), reads)


@query("ct uniq", f"with {contigs_sql('g', 'assistant')}, {hits_sql('h', 'uniq', 'g', 1)} select seq, ref_id, pos, strand, mm, count(*) over (partition by seq) n_hits from h")
def multihit_count(t):
    return ct.multihit_count(aligned_to(t, contigs(t, "assistant"), counted=True)).select(*al.HIT_COLUMNS, "n_hits")


@query("ct uniq", f"with {contigs_sql('g', 'assistant')}, {hits_sql('h', 'uniq', 'g', 1)} select seq, ref_id, pos, strand, round(1.0/count(*) over (partition by seq),6) weight from h")
def hit_weights(t):
    rows = ct.hit_weights(aligned_to(t, contigs(t, "assistant"), counted=True))
    return rows.select("seq", "ref_id", "pos", "strand", F.round("weight", 6).alias("weight"))


@query("ct uniq", f"""with {contigs_sql('g', 'assistant')}, {hits_sql('h', 'uniq', 'g', 1)},
 c as (select *, count(*) over (partition by seq) nh from h),
 u as (select ref_id, strand, pos, count(*) v from c where nh=1 group by all),
 q as (select distinct ref_id, strand, pos from c where nh>1),
 k as (select q.ref_id, q.strand, q.pos, sum(v) near from q join u on u.ref_id=q.ref_id and u.strand=q.strand and u.pos between q.pos-50 and q.pos+50 group by all),
 r as (select c.*, coalesce(near,0) near from c left join k using (ref_id, strand, pos))
 select seq, ref_id, pos, strand, round(case when sum(near) over (partition by seq)>0 then near/sum(near) over (partition by seq) else 1.0/nh end,6) weight from r""")
def density_weights(t):
    """Reads with several hits shared by the unique hits within 50 bases."""
    rows = ct.density_weights(aligned_to(t, contigs(t, "assistant"), counted=True), 50)
    return rows.select("seq", "ref_id", "pos", "strand", F.round("weight", 6).alias("weight"))


_REGIONS = """rg as (select contig, i*40 a, least(i*40+16+(i*7)%33, length(dna)) b, case when i%2=1 then '-' else '+' end strand, dna from
  (select contig, dna, unnest(range(0, 1+(length(dna)-1)//40)) i from ct where length(dna)>0) x)"""


_REGION_SQL = f"""with {_REGIONS} select contig, a as start_pos, b as end_pos, strand, concat(contig,':',cast(a as varchar),'-',cast(b as varchar),'(',strand,')') fasta_id,
 case strand when '-' then reverse(translate(substring(dna,cast(a+1 as int),cast(b-a as int)),'ACGT','TGCA')) else substring(dna,cast(a+1 as int),cast(b-a as int)) end seq from rg"""


@query("ct", _REGION_SQL)
def getfasta(t):
    """Regions every 40 bases of every contig."""
    return _regions_of(t, t("ct").select("contig", F.col("dna").alias("seq")))


def _regions_of(t, contigs):
    size = F.length("dna")
    every = t("ct").filter(size > 0).select("contig", size.alias("size"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((size - 1) / 40))).alias("i"))
    a = F.col("i") * 40
    regions = every.select(
        "contig", a.alias("start"), F.least(a + 16 + (F.col("i") * 7) % 33, "size").cast("bigint").alias("end"),
        F.when(F.col("i") % 2 == 1, "-").otherwise("+").alias("strand"),
    )
    out = iv.extract_sequences(regions, contigs, chunk=256)
    return out.withColumnsRenamed({"start": "start_pos", "end": "end_pos"})


def _contig_tiles(t, tile):
    """The contigs written as FASTA and read back as tiles, by splits that are shorter than many records."""
    rows = t("ct").select("contig", F.regexp_replace("dna", "(.{60})", "$1\n").alias("seq"))
    path = f"{staging_folder(rows.sparkSession)}/contigs-{uuid.uuid4().hex}"
    sinks.write_fasta(rows, path, "contig")
    return read_fasta_tiles(rows.sparkSession, path, tile, split_bytes=16 << 10).withColumnRenamed("ref_id", "contig")


@query("ct", """select contig, cast(i as bigint) tile, cast(i*64 as bigint) start_pos, substring(dna, cast(i*64+1 as int), 64) seq
 from (select contig, dna, unnest(range(0, 1+greatest(length(dna)-1,0)//64)) i from ct) x""")
def fasta_tiles(t):
    """Tiles of 64 bases of records that several tasks read."""
    return _contig_tiles(t, 64).select("contig", "tile", F.col("start").alias("start_pos"), "seq")


@query("ct", _REGION_SQL)
def getfasta_tiles(t):
    """The regions of ``getfasta``, cut from tiles of a FASTA file."""
    return _regions_of(t, _contig_tiles(t, 256).select("contig", "tile", "seq"))
