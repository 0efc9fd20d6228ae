"""The pipeline against plain versions of its stages, and the registered queries."""

import re
import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from corpus import SCHEMA, odd_rows, random_rows, row  # noqa: E402
from test_operators import plain_components, plain_dedup  # noqa: E402

import __spark_entry__ as entry_points  # noqa: E402
import corpus_pipeline  # noqa: E402
from ribolake.llm import mixing, packing, quality  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    junk = [row(500 + i, " ".join(["buy!!", "now###", "WIN"] * (20 + i))) for i in range(40)]
    spark.createDataFrame(random_rows() + junk, SCHEMA).write.parquet(f"{path}/documents.parquet")
    marks = [(i, 1, 0) for i in range(0, 120, 2)] + [(500 + i, 0, 0) for i in range(40)]
    spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_pipeline_equals_plain_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    good = {r.doc_id for r in quality.classified(docs, labels).collect() if r.predicted}
    assert all(i in good for i in range(120)) and not any(i in good for i in range(500, 540))
    rows = [r for r in docs.collect() if r.doc_id in good]
    texts = {d: t for (d, _), t in plain_dedup(rows, 100).items() if re.search(r"\S", t)}
    components = plain_components(sorted(texts.items()), 5, 80)
    kept = {d for d, n, c in components if not n or d == c}
    source = {r.doc_id: (r.lang, r.source) for r in rows}
    left = spark.createDataFrame([row(d, texts[d], *source[d]) for d in kept], SCHEMA)
    repeats = {r.doc_id: r.repeats for r in mixing.mixture(left).collect()}
    encoder = packing.encoder(packing.tokenizer_path())
    want = {d: repeats[d] * (len(encoder.encode([texts[d]])[0]) // 2 + 1) for d in kept if repeats[d]}
    got = Counter()
    for r in corpus_pipeline.run(spark, folder).collect():
        got[r.doc_id] += r.length
    assert got == want


def test_stages_keep_columns_on_odd_and_empty_tables(spark, folder):
    for docs in (spark.createDataFrame(odd_rows(), SCHEMA), spark.createDataFrame([], SCHEMA)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, folder)
            assert out.columns == docs.columns, name
            docs = spark.createDataFrame(out.collect(), SCHEMA)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() >= 0


def test_one_query_an_operator():
    names = [n for n in entry_points.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry_points.queries() and len(corpus_pipeline.STAGES) == 5


@pytest.mark.skipif(not Path(SF).exists(), reason="test tables absent")
@pytest.mark.parametrize("name", [n for n in entry_points.oracle_sql() if re.match(r"op\d+_", n)])
def test_query_matches_sql(spark, name):
    import duckdb

    from tools.check import canonical

    con = duckdb.connect()
    for table in ("documents", "embeddings", "labels", "conversations", "benchmark"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    got = entry_points.queries()[name](spark, SF).toArrow().to_pandas(integer_object_nulls=True)
    want = con.sql(entry_points.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and canonical(got) == canonical(want)
