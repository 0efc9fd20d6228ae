"""Small-RNA inputs derived from the whole test tables, for Spark and for DuckDB.

Every table is written once in a form both engines run; the few spellings that differ
are filled in per engine. ``spark_table`` gives a DataFrame, ``with_tables`` the
``WITH`` clause for DuckDB.
"""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.staging import shuffles_dropped, staging_folder

# Fixed value: the 3' adapter put onto a third of the reads.
ADAPTER = "TGGAATTCTCGGGTGCCAAGG"

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Tables whose rows unfold into many reads, with the column that spreads them.
TEXT_KEYS = {"documents": "doc_id", "conversations": "conv_id", "benchmark": "item_id"}

_DIALECT = {
    "spark": {
        "dna": "translate(regexp_replace(lower({0}),'[^a-z]',''),'abcdefghijklmnopqrstuvwxyz','ACGTACGTACGTACGTNCGTACGTAC')",
        "each": "explode(sequence(0, cast({0} as int)))",
        "div": "(({0}) div ({1}))",
        "list": "array({0})",
    },
    "duckdb": {
        "dna": "translate(regexp_replace(lower({0}),'[^a-z]','','g'),'abcdefghijklmnopqrstuvwxyz','ACGTACGTACGTACGTNCGTACGTAC')",
        "each": "unnest(range(0, 1+cast({0} as int)))",
        "div": "(({0}) // ({1}))",
        "list": "[{0}]",
    },
}

# Windows of a text every ``step`` bases, in two levels so that no window is sought
# from the start of a long text: blocks of 100 windows first, then the windows.
_CUT = """
 select {key}, i, substring(block, cast(1+(i%100)*{step} as int), cast({size} as int)) w
 from (select {key}, block, b*100+j i
  from (select {key}, b, block, @each(@div(least(length(block),100*{step})-1,{step})) j
   from (select {key}, b, substring(dna, cast(1+b*100*{step} as int), 100*{step}+64) block
    from (select {key}, dna, @each(@div(length(dna)-1,100*{step})) b from {source} where length(dna)>0) c) f) g) h"""

_SPIKE = """
 select {key}, i, case when i%2=1 then reverse(translate(q,'ACGT','TGCA')) else q end seq
 from (select {key}, i,
   case when i%5=1 then concat(substring(w,1,8),translate(substring(w,9,1),'ACGT','CGTA'),substring(w,10))
        when i%5=2 then concat(substring(w,1,3),translate(substring(w,4,2),'ACGT','CGTA'),substring(w,6))
        else w end q
   from ({cut}) k) j where length(q)>=15"""

# Tables by name; a table may use the ones before it.
TABLES: dict[str, str] = {
    # Aligned reads: two parts share a locus, a locus every 1600 bases.
    "iv": """
 select concat('S',cast(l_orderkey%2 as string)) sample,
   concat('c',cast(l_partkey%20 as string)) contig,
   cast(@div(l_partkey,40)*1600+(l_orderkey*7+l_linenumber)%60 as bigint) s,
   cast(@div(l_partkey,40)*1600+(l_orderkey*7+l_linenumber)%60+15+l_quantity as bigint) e,
   case l_linestatus when 'O' then '+' else '-' end strand,
   concat('r',cast(l_orderkey as string),'_',cast(l_linenumber as string),'_',cast(l_partkey as string),'_',cast(l_suppkey as string)) rid
 from lineitem""",
    # Annotation on the same contigs.
    "an": """
 select concat('c',cast(o_custkey%20 as string)) contig,
   cast(@div(o_custkey,20)*1067+(o_orderkey*53)%1067 as bigint) s,
   cast(@div(o_custkey,20)*1067+(o_orderkey*53)%1067+20+o_orderkey%60 as bigint) e,
   case substring(o_orderpriority,1,1) when '1' then 'CDS' when '2' then 'CDS'
     when '3' then 'gene' when '4' then 'rRNA' else 'region' end ftype,
   case o_orderstatus when 'F' then '+' when 'O' then '-' else '.' end strand,
   o_orderkey aid
 from orders""",
    # The same annotation as GFF text lines.
    "gff": """
 select concat(contig,chr(9),'src',chr(9),ftype,chr(9),
   case when aid%7=0 then cast(e as string) else cast(s+1 as string) end,chr(9),
   case when aid%7=0 then cast(s+1 as string) else cast(e as string) end,chr(9),'.',chr(9),strand,chr(9),'0',chr(9),
   'ID=f',cast(aid as string),';Name=n',cast(aid%100 as string)) line
 from an
 union all select concat('# contig note ',r_name) from region
 union all select concat('short',chr(9),'line',chr(9),n_name) from nation""",
    # SAM text lines of the aligned reads; returned items are unmapped records.
    "sam": """
 select concat(rid,chr(9),cast(case when l_returnflag='R' then 4 when l_linestatus='O' then 0 else 16 end as string),chr(9),
   concat('c',cast(l_partkey%20 as string)),chr(9),
   cast(cast(@div(l_partkey,40)*1600+(l_orderkey*7+l_linenumber)%60+1 as bigint) as string),chr(9),'255',chr(9),
   cast(cast(15+l_quantity as int) as string),'M',chr(9),'*',chr(9),'0',chr(9),'0',chr(9),
   repeat('A',cast(15+l_quantity as int)),chr(9),repeat('I',cast(15+l_quantity as int)),chr(9),'XA:i:0',chr(9),'NM:i:',cast(l_linenumber%2 as string)) line
 from (select *, concat('r',cast(l_orderkey as string),'_',cast(l_linenumber as string),'_',cast(l_partkey as string),'_',cast(l_suppkey as string)) rid from lineitem) t
 union all select concat('@SQ',chr(9),'SN:',n_name,chr(9),'LN:1') from nation""",
    # Reference panels from the benchmark texts, eight classes.
    "pn": """
 select item_id, concat('p',cast(item_id as string)) ref_id,
   case item_id%8 when 0 then 'host_miRNA' when 1 then 'host_tRNA' when 2 then 'host_rRNA' when 3 then 'host_other'
     when 4 then 'rRNA' when 5 then 'tRNA' when 6 then 'miRNA' else 'rfam' end panel,
   @dna(text) dna from benchmark""",
    # Host transcripts and the assembly from the conversations.
    "ct": """
 select concat('k',cast(conv_id as string),'_',cast(turn as string)) contig, conv_id*100+turn ctid, role, @dna(text) dna
 from conversations""",
    # Reads: windows over whole documents, panels and contigs.
    "rd": "select doc_id, i, w seq from (" + _CUT.format(
        key="doc_id", step=15, size="15+(doc_id*7+i*3)%45", source="(select doc_id, @dna(text) dna from documents) d"
    ) + ") x",
    "sp": _SPIKE.format(key="item_id", cut=_CUT.format(key="item_id", step=11, size="18+(i*5)%23", source="pn")),
    "sc": _SPIKE.format(key="ctid", cut=_CUT.format(key="ctid", step=16, size="16+(i*7)%33", source="ct")),
    "inserts": """
 select concat('S',cast(doc_id%4 as string)) sample, concat('d',cast(doc_id as string),'_',cast(i as string)) read_id, seq insert_seq, doc_id+i k from rd
 union all
 select concat('S',cast((item_id+r)%4 as string)), concat('b',cast(item_id as string),'_',cast(i as string),'_',cast(r as string)), seq, item_id+i+r
 from (select item_id, i, seq, @each(2) r from sp) t
 union all
 select concat('S',cast(ctid%4 as string)), concat('c',cast(ctid as string),'_',cast(i as string)), seq, ctid+i from sc""",
    "reads": """
 select sample, read_id, insert_seq, concat(insert_seq, ad) seq, translate(concat(insert_seq, ad),'ACGTN','I?5#!') qual
 from (select *, case when k%3=0 then substring('TGGAATTCTCGGGTGCCAAGG',1,cast(5+k%17 as int)) else '' end ad from inserts) a""",
    # Reads fit for alignment, and each distinct one once.
    "clean": "select sample, read_id, insert_seq seq from inserts where length(insert_seq) between 15 and 250",
    "uniq": "select distinct seq from clean",
    "coll": "select sample, seq, count(*) n from clean group by sample, seq",
    # tRNA and family dimensions.
    "dim": """
 select concat('ref',cast(p_partkey as string)) ref_id, concat('acc',cast(p_partkey%97 as string)) accession,
   split_part(p_type,' ',1) family_class, p_brand family,
   concat('aa',cast(p_size%20 as string)) aa, concat('ac',cast(p_size as string)) anticodon, r_name phylum, n_name species
 from part join nation on n_nationkey=p_partkey%25 join region on r_regionkey=n_regionkey""",
    "dimhits": """
 select concat('S',cast(l_orderkey%4 as string)) sample, concat('ref',cast(l_partkey as string)) ref_id, cast(l_quantity as bigint) n
 from lineitem""",
    # Transfer-RNA references whose ids hold their dimensions in three ways, or not at all.
    "trna": """
 select p_partkey, case p_partkey%4 when 0 then concat(genus,'_tRNA-',aa,'-',ac,'-',cast(p_partkey as string),'-1')
     when 1 then concat('tdbD',lpad(cast(p_partkey as string),8,'0'),'|',genus,'|',cast(p_size as string),'|',aa,'|',ac)
     when 2 then concat('contig_',cast(p_size as string),'.',cast(p_partkey as string),'.trna',cast(p_size as string),'-',aa,ac)
     else concat('unnamed_',cast(p_partkey as string)) end ref_id,
   case when p_partkey%4<2 then genus end species, case when p_partkey%4<3 then aa end aa, case when p_partkey%4<3 then ac end anticodon
 from (select p_partkey, p_size, case p_size%5 when 0 then 'Homo_sapiens' when 1 then 'Mus_musculus' when 2 then 'Escherichia_coli' when 3 then 'Zea_mays' else 'Danio_rerio' end genus,
   case p_partkey%7 when 0 then 'Ala' when 1 then 'Gly' when 2 then 'fMet' when 3 then 'SeC' when 4 then 'Leu' when 5 then 'Ser' else 'Val' end aa,
   case p_size%6 when 0 then 'AGC' when 1 then 'TTG' when 2 then 'CAT' when 3 then 'GCC' when 4 then 'TCA' else 'CAA' end ac from part) p""",
    "phyla": """
 select case r_regionkey when 0 then 'Homo_sapiens' when 1 then 'Mus_musculus' when 2 then 'Escherichia_coli' when 3 then 'Zea_mays' else 'Xenopus_laevis' end species,
   case r_regionkey when 2 then 'Pseudomonadota' when 3 then 'Streptophyta' else 'Chordata' end phylum from region""",
    "trnahits": """
 select concat('S',cast(l_orderkey%4 as string)) sample, ref_id, cast(l_quantity as bigint) n from lineitem join trna on p_partkey=l_partkey""",
    # Accessions with a taxon; every second accession has none.
    "acctax": "select concat('acc',cast(s_suppkey*2 as string)) accession, cast(1000+s_suppkey as int) taxid from supplier",
    # Panel records of 13 biotypes and several species.
    "nc": """
 select concat(case p_partkey%4 when 0 then 'hsa-' when 1 then 'mmu-' when 2 then 'dme-' else 'ath-' end, replace(p_name,' ','-'),'-',cast(p_partkey as string)) ref_id,
   concat('ncrna chromosome:x gene_biotype:', case p_partkey%13 when 0 then 'lncRNA' when 1 then 'miRNA' when 2 then 'misc_RNA' when 3 then 'Mt_rRNA'
     when 4 then 'Mt_tRNA' when 5 then 'ribozyme' when 6 then 'rRNA' when 7 then 'scaRNA' when 8 then 'snoRNA' when 9 then 'snRNA'
     when 10 then 'sRNA' when 11 then 'vault_RNA' else 'protein_coding' end, ' gene:', p_brand) description,
   @dna(concat(p_name,p_type,p_brand,p_name)) seq,
   case p_size%12 when 0 then 'Gene; rRNA;' when 1 then 'Gene; tRNA;' when 2 then 'Gene; miRNA;' when 3 then 'Gene; snRNA; snoRNA; CD-box;'
     when 4 then 'Gene; snRNA; splicing;' when 5 then 'Gene; antisense;' when 6 then 'Gene; ribozyme;' when 7 then 'Cis-reg; leader;' when 8 then 'Gene; CRISPR;'
     when 9 then 'Cis-reg; riboswitch;' when 10 then 'Cis-reg; IRES;' else 'Intron;' end kind
 from part""",
    # Taxonomy: root 1, regions 10+, nations 100+, suppliers 1000+.
    "tax": """
 select cast(1000+s_suppkey as int) taxid, cast(100+n_nationkey as int) parent, 'species' rank, s_name name,
   @list(cast(1 as int),cast(10+n_regionkey as int),cast(100+n_nationkey as int),cast(1000+s_suppkey as int)) lineage
 from supplier join nation on s_nationkey=n_nationkey
 union all select cast(100+n_nationkey as int), cast(10+n_regionkey as int), 'order', n_name,
   @list(cast(1 as int),cast(10+n_regionkey as int),cast(100+n_nationkey as int)) from nation
 union all select cast(10+r_regionkey as int), 1, 'phylum', r_name, @list(cast(1 as int),cast(10+r_regionkey as int)) from region
 union all select 1, 0, 'root', 'root', @list(cast(1 as int))""",
    "pntax": """
 select ref_id, dna seq, cast(1000+item_id%(select count(*) from supplier) as int) taxid from pn""",
}


def _fill(sql: str, engine: str) -> str:
    """Replace ``@name(args)`` by the engine's spelling, innermost first."""
    spell = _DIALECT[engine]
    call = re.compile(r"@(\w+)\(")
    while True:
        found = None
        for found in call.finditer(sql):
            pass
        if found is None:
            return sql
        depth, at, args, last = 1, found.end(), [], found.end()
        while depth:
            ch = sql[at]
            depth += (ch == "(") - (ch == ")")
            if depth == 0 or (depth == 1 and ch == ","):
                args.append(sql[last:at])
                last = at + 1
            at += 1
        shape = spell[found.group(1)]
        text = shape.format(",".join(args)) if found.group(1) == "list" else shape.format(*args)
        sql = sql[: found.start()] + text + sql[at:]


# Tables that Spark writes once for all others that rest on them. Behind ``inserts`` stands all the cutting of
# texts: written, it is done once a session, and filters on reads do not repeat its expressions.
STORED = ("pn", "ct", "inserts")


def _needs(name: str, stored: tuple[str, ...] = ()) -> list[str]:
    """The derived tables ``name`` rests on, in order, itself last; not those behind ``stored`` ones."""
    out: list[str] = []
    for word in re.findall(r"\b(?:from|join)\s+(\w+)", TABLES[name]):
        if word in TABLES and word != name and word not in stored:
            out += [n for n in _needs(word, stored) if n not in out]
    return [*out, name]


_WRITTEN: dict[tuple[str, str, str], str] = {}


def spark_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base or derived table as a DataFrame.

    A derived table stands for stored input: Spark derives it once in a session and
    writes it to the staging folder, so queries scan it as they would real reads.
    """
    if name in BASE_TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    key = (spark.sparkContext.applicationId, sf_dir, name)
    try:
        return spark.read.parquet(_WRITTEN[key])
    except (KeyError, AnalysisException):
        path = f"{staging_folder(spark)}/input-{name}-{uuid.uuid4().hex}"
        derived = _derived(spark, sf_dir, name)
        with shuffles_dropped(spark):
            derived.write.option("compression", "zstd").parquet(path)
        _WRITTEN[key] = path
        return spark.read.parquet(path)


def _derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ctes = []
    for n in _needs(name, STORED):
        ctes.append(f"{n} as ({_fill(TABLES[n], 'spark')})")
    text = "with " + ",\n".join(ctes) + f"\nselect * from {name}"
    given = {*BASE_TABLES, *STORED} - {name}
    used = sorted({w for w in re.findall(r"\b(?:from|join)\s+(\w+)", text) if w in given})
    text = re.sub(
        r"\b(from|join)\s+(" + "|".join(used) + r")\b", r"\1 {\2}", text
    )
    frames = {t: spark_table(spark, sf_dir, t) for t in used}
    for t, key in TEXT_KEYS.items():
        if t in frames:
            # One row group, so one task, unless dealt out.
            frames[t] = frames[t].repartition(F.col(key))
    return spark.sql(text, **frames)


def with_tables(names: str, body: str) -> str:
    """DuckDB text: the named derived tables as CTEs, then ``body``."""
    order: list[str] = []
    for name in names.split():
        order += [n for n in _needs(name) if n not in order]
    body = _fill(body, "duckdb").strip()
    ctes = ",\n".join(f"{n} as ({_fill(TABLES[n], 'duckdb')})" for n in order)
    return f"with {ctes}, {body[5:]}" if body.lower().startswith("with ") else f"with {ctes}\n{body}"
