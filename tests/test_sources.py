import gzip

import pytest

from ribolake.operators import panels as pl
from ribolake.sources import sinks
from ribolake.sources.fasta import read_fasta
from ribolake.operators import align as al
from ribolake.sources.fasta_tiles import _stretches, read_fasta_tiles
from ribolake.sources.fastq import read_fastq, read_samples
from ribolake.sources.gff import gff_intervals, gff_wide, read_gff
from ribolake.sources.sam import read_sam
from ribolake.sources.tables import count_file_totals, read_accession_taxa, read_family_hits, read_sample_sheet, read_summaries


def records(n):
    return [(f"r{i}", "ACGT" * (1 + i % 5), ("@+I#" * (1 + i % 5))) for i in range(n)]


def fastq(rows):
    return "".join(f"@{i} extra\n{s}\n+\n{q}\n" for i, s, q in rows)


def test_fastq_plain_and_gzip(spark, tmp_path):
    rows = records(500)
    (tmp_path / "a.fastq").write_text(fastq(rows) + "@cut\nACGT\n")
    with gzip.open(tmp_path / "b.fastq.gz", "wb") as f:
        f.write(fastq(rows).encode() + b"@bad\xff\nA\xfeC\n+\nII\n")
    for size in (1, 97, 4096, 1 << 20):
        got = read_fastq(spark, str(tmp_path / "a.fastq"), split_bytes=size if size > 1 else 61)
        assert sorted(map(tuple, got.collect())) == sorted(rows)
    got = read_fastq(spark, str(tmp_path / "b.fastq.gz"), "S").collect()
    assert len(got) == 501 and {r["sample"] for r in got} == {"S"}
    assert ("bad", "AC") in {(r["read_id"], r["seq"]) for r in got}
    (tmp_path / "none.fastq").write_text("")
    assert read_fastq(spark, str(tmp_path / "none.fastq")).count() == 0
    both = read_samples(spark, [("x", str(tmp_path / "a.fastq")), ("y", str(tmp_path / "b.fastq.gz"))])
    assert both.filter("sample = 'x'").count() == 500


def test_fastq_sink_reads_back(spark, tmp_path):
    df = spark.createDataFrame(records(50), "read_id string, seq string, qual string")
    sinks.write_fastq(df, str(tmp_path / "out"))
    assert sorted(map(tuple, read_fastq(spark, str(tmp_path / "out")).collect())) == sorted(records(50))


def test_fasta(spark, tmp_path):
    (tmp_path / "x.fa").write_text(">a first > second\nACGT\nAC GT\n>b\nTTTT\n\n>c only header\n")
    got = {r["ref_id"]: (r["description"], r["seq"]) for r in read_fasta(spark, str(tmp_path / "x.fa")).collect()}
    assert got == {"a": ("first > second", "ACGTACGT"), "b": ("", "TTTT"), "c": ("only header", "")}


FASTA = (
    "no record yet\n>a first > second\r\nACGTAC\nGT>T\n\n>b\n>c only header, 0123456789\n>long\n" + "ACGTTGCAN" * 150 + "\n"
    + "\n".join("ACGGT" * 4 for _ in range(40)) + "\n>a twice\nT T\nG"
)


def plain_records(text):
    out, at = [], 0
    for line in text.split("\n"):
        if line.startswith(">"):
            out.append([at, line[1:].strip(), ""])
        elif out:
            out[-1][2] += "".join(line.split())
        at += len(line) + 1
    return [(at, *(header.split(None, 1) + ["", ""])[:2], seq) for at, header, seq in out]


def rebuilt(df, tile):
    found = {}
    for r in df.collect():
        assert r["start"] == r["tile"] * tile and len(r["seq"]) <= tile
        found.setdefault((r["record_at"], r["ref_id"], r["description"]), []).append((r["start"], r["seq"]))
    for pieces in found.values():
        pieces.sort()
        assert [s for s, _ in pieces] == [i * tile for i in range(len(pieces))] and all(len(x) == tile for _, x in pieces[:-1])
    return sorted((*key, "".join(x for _, x in pieces)) for key, pieces in found.items())


def test_fasta_tiles_for_any_split(spark, tmp_path):
    (tmp_path / "x.fa").write_bytes(FASTA.encode())
    with gzip.open(tmp_path / "y.fa.gz", "wb") as f:
        f.write(FASTA.encode())
    want = plain_records(FASTA)
    assert len(want) == 5 and max(len(r[3]) for r in want) > 2000
    for split, tile in ((7, 100), (41, 64), (1000, 1000), (1 << 20, 4096)):
        df = read_fasta_tiles(spark, str(tmp_path / "x.fa"), tile, split)
        assert rebuilt(df, tile) == want, split
    assert rebuilt(read_fasta_tiles(spark, str(tmp_path / "y.fa.gz"), 64), 64) == want
    (tmp_path / "empty.fa").write_text("")
    assert read_fasta_tiles(spark, str(tmp_path / "empty.fa")).count() == 0


def test_stretches_of_every_split_make_the_file():
    import io

    text = FASTA.encode()
    for size in range(1, 160):
        got, seqs = [], []
        for start in range(0, len(text), size):
            for record, header, at, bases in _stretches(io.BytesIO(text), start, min(start + size, len(text))):
                if record is not None and (not got or got[-1][0] != record):
                    got.append((record, header.decode().strip()))
                    seqs.append(b"")
                if seqs:
                    seqs[-1] += bases
        joined = [(at, *(h.split(None, 1) + ["", ""])[:2], s.decode()) for (at, h), s in zip(got, seqs)]
        assert joined == plain_records(FASTA), size


def test_index_of_tiles_is_the_index_of_records(spark, tmp_path):
    import random

    rnd = random.Random(1)
    refs = [(f"r{i}", "".join(rnd.choice("ACGTN" if i else "ACGT") for _ in range(n))) for i, n in enumerate((3000, 700, 512, 256, 30))]
    (tmp_path / "x.fa").write_text("".join(f">{n}\n{s}\n" for n, s in refs))
    whole = al.build_index(spark.createDataFrame(refs, "ref_id string, seq string"), max_length=64, tile=256)
    tiled = al.build_index(read_fasta_tiles(spark, str(tmp_path / "x.fa"), 256, 300).select("ref_id", "tile", "seq"), max_length=64, tile=256)
    rows = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))
    assert tiled.k == whole.k and rows(tiled.tiles) == rows(whole.tiles) and rows(tiled.seeds) == rows(whole.seeds)
    with pytest.raises(ValueError):
        al.build_index(read_fasta_tiles(spark, str(tmp_path / "x.fa"), 16).select("ref_id", "tile", "seq"), max_length=64, tile=16)


def test_gff(spark, tmp_path):
    line = lambda *f: "\t".join(map(str, f))
    (tmp_path / "x.gff").write_text("\n".join([
        "##gff-version 3", "", line("c", "s", "CDS", 11, 20, ".", "+", "0", 'ID=f1;note="x"'), line("c", "s", "gene", 30, 21, ".", "-", ".", "ID=f2"),
        line("c", "s", "region", 1, 500, ".", "+", "."), line("c", "s", "CDS", 0, 5, ".", ".", "."), line("too", "few", "CDS", 1, 2, ".", "+"),
    ]))
    gff = read_gff(spark, str(tmp_path / "x.gff"))
    assert sorted((r["start"], r["end"], r["ftype"], r["strand"]) for r in gff_intervals(gff).collect()) == [
        (0, 5, "CDS", "."), (10, 20, "CDS", "+"), (21, 29, "gene", "-")
    ]
    wide = gff_wide(gff).collect()
    assert len(wide) == 4 and {r["id"] for r in wide} == {"f1", "f2", ""}


def test_sam(spark, tmp_path):
    (tmp_path / "x.sam").write_text("@HD\tVN:1\nq\t16\tc\t5\t255\t4M\t*\t0\t0\tACGT\tIIII\tXA:i:0\tMD:Z:4\nshort\t0\tc\t1\n")
    row = read_sam(spark, str(tmp_path / "x.sam")).collect()
    assert len(row) == 1 and row[0]["tags"] == {"XA:i": "0", "MD:Z": "4"} and row[0]["pos"] == 5


def test_sample_sheet(spark, tmp_path):
    path = tmp_path / "s.tsv"
    path.write_text("name\tfastq\ttype\n a \tx.fq\t\n\t\t\nb\ty.fq\tt\n")
    assert sorted((r["name"], r["type"], r["assembly_gff"]) for r in read_sample_sheet(spark, str(path)).collect()) == [("a", "", ""), ("b", "t", "")]
    for text, problem in (("name\ttype\na\tb\n", "lacks columns: fastq"), ("name\tfastq\na\t\n", "without name or fastq"),
                          ("name\tfastq\na\tx\na\ty\n", "duplicate"), ("name\tfastq\n\t\n", "no usable rows")):
        path.write_text(text)
        with pytest.raises(ValueError, match=problem):
            read_sample_sheet(spark, str(path))


def test_small_tables(spark, tmp_path):
    (tmp_path / "hits").write_text("# c\nfam RF1  q1 x\n\nfam RF2 q2\nfam only\n")
    assert sorted(r[0] for r in read_family_hits(spark, str(tmp_path / "hits")).collect()) == ["q1", "q2"]
    (tmp_path / "taxa").write_text("acc\t12\tname\nacc2\t13\n")
    assert sorted((r[0], r[1], r[2]) for r in read_accession_taxa(spark, str(tmp_path / "taxa")).collect()) == [("acc", 12, "name"), ("acc2", 13, None)]
    (tmp_path / "counts").write_text("f\treads\na\t1.5\nb\t\nc\t2\n")
    assert count_file_totals(spark, str(tmp_path / "counts")).first()[0] == 3.5
    (tmp_path / "counts3").write_text("f\tnote\treads\na\tx\t2\nb\ty\tno number\n")
    assert count_file_totals(spark, [str(tmp_path / "counts"), str(tmp_path / "counts3")]).first()[0] == 5.5
    (tmp_path / "sum.tsv").write_text("sample\tcategory\treads\nS\tinput\t7\nbad\tline\nsample\tinput\t8\n")
    paths = [str(tmp_path / "sum.tsv"), str(tmp_path / "absent.tsv")]
    assert sorted(tuple(r) for r in read_summaries(spark, paths).collect()) == [("sum.tsv", "S", "input", "7"), ("sum.tsv", "sample", "input", "8")]
    assert read_summaries(spark, paths[1:]).count() == 0


def test_family_classes(spark):
    from pyspark.sql import functions as F

    kinds = ["Gene; snRNA; snoRNA; CD-box;", "Gene; snRNA; splicing;", "Cis-reg; riboswitch;", "Intron;"]
    df = spark.createDataFrame([(k,) for k in kinds], "k string")
    assert [r[0] for r in df.select(pl.family_class(F.col("k"))).collect()] == ["snoRNA", "snRNA", "riboswitch", "other"]
