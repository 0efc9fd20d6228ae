"""Read-level queries: reads cut from whole documents, panels and contigs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sequence as sq
from ..operators import quality as qc
from ..operators import reads as rd
from ..operators import samples as sm
from .catalog import query
from .inputs import ADAPTER

_TRIM_CASES = " ".join(
    f"when ends_with(seq,'{ADAPTER[:n]}') then length(seq)-{n}" for n in range(len(ADAPTER) - 1, 3, -1)
)
TRIMMED = f"""
 trimmed as (select sample, read_id, insert_seq, seq[1:cut] seq, qual[1:cut] qual from (select *,
   case when contains(seq,'{ADAPTER}') then strpos(seq,'{ADAPTER}')-1 {_TRIM_CASES} else length(seq) end cut from reads) x)"""
PASSED = TRIMMED + """,
 good as (select * from trimmed where length(regexp_replace(qual,'[^!-/]','','g'))*100 <= 40*length(seq) and length(seq)-length(replace(seq,'N','')) <= 5),
 passed as (select * from good where length(seq) between 15 and 250)"""


def trimmed(t):
    return rd.trim_adapter(t("reads"), ADAPTER)


def passed(t):
    return rd.length_filter(rd.quality_filter(trimmed(t)))


@query("reads", "select sample, read_id, seq from reads where length(seq) >= 15 and length(seq) <= 250")
def length_filter(t):
    return rd.length_filter(t("reads")).select("sample", "read_id", "seq")


@query("reads", f"with {TRIMMED} select sample, read_id, seq, qual from trimmed")
def adapter_trim(t):
    return trimmed(t).select("sample", "read_id", "seq", "qual")


# Every second read with an adapter has one base of it misread.
_MISREAD = f"""case when read_id like '%1' then concat(insert_seq, substring(seq,length(insert_seq)+1,2), translate(substring(seq,length(insert_seq)+3,1),'ACGT','CGTA'), substring(seq,length(insert_seq)+4)) else seq end"""
_ADAPTER_ERRORS = f"""
 m as (select sample, read_id, {_MISREAD} seq from reads),
 c as (select *, list_filter(range(0, greatest(length(seq)-3,0)), lambda p: hamming(seq[p+1:p+least({len(ADAPTER)},length(seq)-p)], '{ADAPTER}'[1:least({len(ADAPTER)},length(seq)-p)]) <= floor(least({len(ADAPTER)},length(seq)-p)*0.1))[1] cut from m)"""


@query("reads", f"with {_ADAPTER_ERRORS} select sample, read_id, case when cut is null then seq else seq[1:cut] end seq from c")
def adapter_trim_errors(t):
    seq, n = F.col("seq"), F.length("insert_seq")
    rest = lambda at, size: F.substring("seq", n + at, F.lit(size) if isinstance(size, int) else size)
    wrong = F.concat("insert_seq", rest(1, 2), F.translate(rest(3, 1), "ACGT", "CGTA"), rest(4, F.length("seq")))
    reads = t("reads").select("sample", "read_id", F.when(F.col("read_id").endswith("1"), wrong).otherwise(seq).alias("seq"))
    return rd.trim_adapter_with_errors(reads, ADAPTER, 0.1)


def detected_sql(reads: str) -> str:
    """CTE ``adapters``(sample, adapter, reads) for the reads in ``reads``."""
    return f"""
 dr as (select distinct sample, seq from {reads}), dt as (select sample, count(*) total from dr group by sample),
 dk as (select distinct sample, seq, seq[p+1:p+12] kmer from (select sample, seq, unnest(range(15, length(seq)-11)) p from dr where length(seq)>=27) x),
 dc as (select sample, kmer, count(*) n from dk group by all),
 db as (select sample, kmer, n from (select *, row_number() over (partition by sample order by n desc, kmer) rk from dc) x join dt using (sample) where rk=1 and n>=5 and n>=0.1*total),
 dp as (select dr.sample, seq, kmer, n, 15+strpos(seq[16:], kmer) at_ from dr join db using (sample) where contains(seq[16:], kmer)),
 dl as (select sample, n, d, seq[at_-d] base from (select *, unnest(range(1, least(at_-1,40)+1)) d from dp) x),
 ds as (select sample, d, base from (select sample, n, d, base, count(*) c from dl group by all) x where 5*c>=4*n and n>=10),
 dx as (select sample, d, base, row_number() over (partition by sample order by d) rn from ds),
 de as (select sample, string_agg(base, '' order by d desc) ext from dx where d=rn group by sample),
 adapters as (select sample, coalesce(ext,'')||kmer adapter, n reads from db left join de using (sample))"""


@query("reads", f"with {detected_sql('reads')} select * from adapters")
def adapter_detect(t):
    return rd.detect_adapters(t("reads"))


@query("reads", f"with r as (select sample, insert_seq seq from reads), {detected_sql('r')} select * from adapters")
def adapter_detect_none(t):
    """Reads without adapter: no sample has one."""
    return rd.detect_adapters(t("reads").select("sample", F.col("insert_seq").alias("seq")))


_CYCLES = f"select sample, read_id, insert_seq, left(insert_seq||'{ADAPTER}'||repeat('ACGGT',10),50) seq from reads"


def _cycles(t):
    whole = F.concat("insert_seq", F.lit(ADAPTER + "ACGGT" * 10))
    return t("reads").select("sample", "read_id", "insert_seq", F.substring(whole, 1, 50).alias("seq"))


@query("reads", f"with r as ({_CYCLES}), {detected_sql('r')} select * from adapters")
def adapter_detect_fixed_length(t):
    """A run of 50 cycles: every read goes into or beyond the adapter."""
    return rd.detect_adapters(_cycles(t))


_TRIM_FOUND = """ found as (select r.sample, read_id, seq, adapter, case when adapter is null then length(seq) when contains(seq,adapter) then strpos(seq,adapter)-1
   else length(seq)-coalesce(list_max(list_filter(range(4,length(adapter)), lambda n: ends_with(seq, adapter[:n]))),0) end cut from r left join adapters using (sample))
 select sample, read_id, seq[:cut] seq from found"""


@query("reads", f"with r as (select * from reads), {detected_sql('r')}, {_TRIM_FOUND}")
def adapter_trim_detected(t):
    reads = t("reads").select("sample", "read_id", "seq")
    return rd.trim_detected(reads, rd.detect_adapters(reads))


@query("reads", "select sample, read_id, insert_seq seq from reads")
def adapter_trim_none(t):
    """Reads without adapter come back whole."""
    reads = t("reads").select("sample", "read_id", F.col("insert_seq").alias("seq"))
    return rd.trim_detected(reads, rd.detect_adapters(reads))


@query("reads", f"with {PASSED} select sample, read_id, seq from good")
def quality_filter(t):
    return rd.quality_filter(trimmed(t)).select("sample", "read_id", "seq")


_GAPPED = "select sample, read_id, concat(substring(seq,1,5),'-. ',substring(seq,6),'-') seq from reads"


def _gapped(t):
    return t("reads").select(
        "sample", "read_id", F.concat(F.substring("seq", 1, 5), F.lit("-. "), F.substring("seq", F.lit(6), F.length("seq")), F.lit("-")).alias("seq")
    )


@query("reads", f"with g as ({_GAPPED}) select sample, read_id, replace(replace(replace(seq,'-',''),'.',''),' ','') seq from g")
def strip_gaps(t):
    return rd.without_gaps(_gapped(t))


@query("reads", "select sample, seq, count(*) n from reads where length(seq)>=15 group by all")
def min_length(t):
    return rd.length_filter(rd.collapse(t("reads")), 15, None)


@query("reads", """
 select sample, case when length(seq) between 18 and 26 then 'short' when length(seq)>=27 then 'long' else 'too_short' end length_class,
   count(distinct seq) sequences, count(*) reads from reads group by all""")
def length_split(t):
    return rd.length_class(rd.collapse(t("reads"))).groupBy("sample", "length_class").agg(
        F.count("*").alias("sequences"), F.sum("n").alias("reads")
    )


@query("reads", "select distinct seq, repeat('I',length(seq)) qual from reads")
def fake_quality(t):
    return rd.collapse(t("reads"), ()).select("seq", sq.constant_quality(F.col("seq")).alias("qual"))


@query("ct", "select contig, reverse(translate(dna,'ACGT','TGCA')) seq from ct")
def revcomp(t):
    return t("ct").select("contig", sq.revcomp(F.col("dna")).alias("seq"))


@query("", "select l_orderkey, l_linenumber, l_partkey, l_suppkey, printf('%.2f', l_quantity/7) shown from lineitem")
def format2(t):
    return t("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", sq.two_decimals(F.col("l_quantity") / 7).alias("shown")
    )


# A sample sheet from customer: blanks among the optional fields, names repeated.
_SHEET = """select case when c_custkey%50=0 then 'dup' else c_name end as name, case when c_custkey%3=0 then ' ' else lower(c_mktsegment) end as type,
   concat('/in/',cast(c_custkey as string),'.fastq.gz') fastq, case when c_custkey%4=0 then '' else 'a.fa' end assembly_fasta, case when c_custkey%5=0 then '' else 'a.gff' end assembly_gff from customer"""


def _sheet(t):
    key = F.col("c_custkey")
    return t("customer").select(
        F.when(key % 50 == 0, "dup").otherwise(F.col("c_name")).alias("name"),
        F.when(key % 3 == 0, " ").otherwise(F.lower("c_mktsegment")).alias("type"),
        F.concat(F.lit("/in/"), key.cast("string"), F.lit(".fastq.gz")).alias("fastq"),
        F.when(key % 4 == 0, "").otherwise("a.fa").alias("assembly_fasta"),
        F.when(key % 5 == 0, "").otherwise("a.gff").alias("assembly_gff"),
    )


@query("", f"""with s as ({_SHEET}) select name, coalesce(nullif(trim(type),''),'sRNA-Ext') as type, fastq,
   coalesce(nullif(trim(assembly_fasta),''),'default.fa') assembly_fasta, nullif(trim(assembly_gff),'') assembly_gff from s""")
def sample_defaults(t):
    return sm.with_defaults(_sheet(t), {"assembly_fasta": "default.fa"})


@query("", f"with s as ({_SHEET}) select name, count(*) as \"rows\" from s group by name having count(*)>1")
def dup_names(t):
    return sm.duplicate_names(_sheet(t))


@query("", f"""with s as ({_SHEET}), w as (select concat('Customer#',lpad(cast(o_custkey*2 as varchar),9,'0')) as name from orders)
 select name, fastq, 'found' state from s where name in (select name from w)
 union all select distinct name, null, 'missing' from w where name not in (select name from s)""")
def select_samples(t):
    """Requests come from orders; every second one is unknown."""
    sheet = _sheet(t)
    wanted = t("orders").select(
        F.concat(F.lit("Customer#"), F.lpad((F.col("o_custkey") * 2).cast("string"), 9, "0")).alias("name")
    )
    found = sm.select_samples(sheet, wanted).select("name", "fastq", F.lit("found").alias("state"))
    return found.unionByName(
        sm.missing_names(sheet, wanted).select("name", F.lit(None).cast("string").alias("fastq"), F.lit("missing").alias("state"))
    )


@query("reads", "select sample, seq, count(*) n from reads group by sample, seq")
def collapse(t):
    return rd.collapse(t("reads"))


@query("reads", """select *, concat(cast(rank as varchar),'-',cast(n as varchar)) collapsed_id from (
 select sample, seq, count(*) n, row_number() over (partition by sample order by count(*) desc, seq) rank from reads group by sample, seq) x""")
def collapse_ranked(t):
    return rd.collapse_ranked(t("reads"))


@query("reads", "select sample, cast(floor(round(avg(length(seq)),1)) as bigint) mean_length from reads group by sample")
def mean_length(t):
    return rd.mean_length(t("reads"))


def _both(t, profile):
    """A profile before and after trimming."""
    return profile(t("reads"), "raw").unionByName(profile(passed(t), "trimmed"))


_STAGES = f"with {PASSED}, st as (select 'raw' stage, sample, seq, qual from reads union all select 'trimmed', sample, seq, qual from passed)"


@query("reads", _STAGES + """,
 pos_rows as (select stage, sample, seq, qual, unnest(range(1, 1+length(seq))) p from st)
 select stage, sample, cast(p as int) as position, count(*) reads, round(sum(ascii(substring(qual,p,1))-33)/count(*),6) mean_quality,
  count(*) filter (substring(seq,p,1)='A') a_bases, count(*) filter (substring(seq,p,1)='C') c_bases, count(*) filter (substring(seq,p,1)='G') g_bases,
  count(*) filter (substring(seq,p,1)='T') t_bases, count(*) filter (substring(seq,p,1)='N') n_bases
 from pos_rows group by all""")
def qc_position(t):
    return _both(t, qc.position_profile)


@query("reads", _STAGES + """,
 pos_rows as (select stage, sample, qual, unnest(range(1, 1+length(seq))) p from st),
 ph as (select stage, sample, p, ascii(substring(qual,p,1))-33 phred from pos_rows)
 select stage, sample, cast(p as int) as position, cast(quantile_disc(phred,0.25) as int) lower, cast(quantile_disc(phred,0.5) as int) median, cast(quantile_disc(phred,0.75) as int) upper from ph group by all""")
def qc_quartiles(t):
    return _both(t, qc.quality_quantiles)


@query("reads", _STAGES + """ select stage, sample, cast(floor((length(seq)-length(translate(seq,'GC','')))*100/length(seq)) as bigint) gc_percent, count(*) reads from st group by all""")
def qc_gc(t):
    return _both(t, qc.gc_histogram)


@query("reads", _STAGES + " select stage, sample, length(seq) as length, count(*) reads from st group by all")
def qc_length(t):
    return _both(t, qc.read_lengths)


@query("reads", _STAGES + """, c as (select stage, sample, seq, count(*) n from st group by all)
 select stage, sample, n copies, count(*) sequences, cast(sum(n) as bigint) reads from c group by all""")
def qc_dup(t):
    return qc.duplication(rd.collapse(t("reads")), "raw").unionByName(qc.duplication(rd.collapse(passed(t)), "trimmed"))
