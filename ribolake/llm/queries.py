"""The registered queries of the numbered operators and the SQL each must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import ann, decontam, licenses, lines, merkle, mixing, ngram_join, packing, pii, quality, rules, sharding, trie
from .common import documents, table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classified(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.found_pii(documents(spark, sf_dir)))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(documents(spark, sf_dir), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(documents(spark, sf_dir))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined(documents(spark, sf_dir), n=3, share=90).select("doc_id", "n_shingles", "component_id")


def op6_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.deduplicated(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    )


def op7_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op8_concat_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir), packing.tokenizer_path())


def op9_water_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken")
    )


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(documents(spark, sf_dir))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(table(spark, sf_dir, "conversations"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audited(documents(spark, sf_dir))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.judged(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_quality, op2_pii, op3_quality_rules, op4_hilbert_shards, op5_ngram_jaccard, op6_line_runs, op7_prefix_forest, op8_concat_and_cut,
    op9_water_filling, op10_licenses, op11_conversation_trie, op12_merkle_manifest, op13_decontamination,
)}
ORACLE = {
    "op2_pii": pii.oracle_sql(), "op3_quality_rules": rules.oracle_sql(), "op5_ngram_jaccard": ngram_join.oracle_sql(3, 90),
    "op6_line_runs": lines.oracle_sql(), "op9_water_filling": mixing.oracle_sql(), "op11_conversation_trie": trie.oracle_sql(),
    "op12_merkle_manifest": merkle.oracle_sql(), "op13_decontamination": decontam.oracle_sql(),
}
