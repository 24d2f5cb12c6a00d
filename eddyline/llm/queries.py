"""The registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eddyline.llm import byte_cnn, chat, feistel_shards, html_crf, line_dedup, manifest, merkle, minhash_forest, packing, poisson_mix, prefix_trie, quality_rules, toxicity
from eddyline.sources.tables import table


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, sf_dir, name)


def op1_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feistel_shards.query(documents(spark, sf_dir))


def op2_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_cnn.query(documents(spark, sf_dir), read(spark, sf_dir, "labels"))


def op3_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_crf.query(read(spark, sf_dir, "pages"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.query(documents(spark, sf_dir))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.query(documents(spark, sf_dir))


def op6_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.query(read(spark, sf_dir, "conversations"))


def op7_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.query(documents(spark, sf_dir))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.query(documents(spark, sf_dir))


def op9_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poisson_mix.query(documents(spark, sf_dir))


def op10_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_forest.query(documents(spark, sf_dir))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.query(documents(spark, sf_dir), read(spark, sf_dir, "labels"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.query(documents(spark, sf_dir))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.query(read(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_feistel_shards": op1_feistel_shards,
    "op2_byte_cnn": op2_byte_cnn,
    "op3_html_crf": op3_html_crf,
    "op4_line_dedup": op4_line_dedup,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_chat_snapshots": op6_chat_snapshots,
    "op7_merkle_fingerprints": op7_merkle_fingerprints,
    "op8_quality_rules": op8_quality_rules,
    "op9_poisson_mix": op9_poisson_mix,
    "op10_minhash_forest": op10_minhash_forest,
    "op11_toxicity": op11_toxicity,
    "op12_manifest": op12_manifest,
    "op13_prefix_trie": op13_prefix_trie,
}
