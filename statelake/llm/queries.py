"""The corpus operators as named queries over the test tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from statelake.llm import decontam, extraction, katz, licenses, merkle, mixing, pii, quality, secrets, simhash, suffix, trie, warc
from statelake.llm.common import read_table


def op1_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extraction.main_text(read_table(spark, folder, "pages"))


def op2_suffix(spark: SparkSession, folder: str) -> DataFrame:
    return suffix.without_repeats(read_table(spark, folder, "documents")).drop("kept")


def op3_katz(spark: SparkSession, folder: str) -> DataFrame:
    return katz.scored(read_table(spark, folder, "documents"))


def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secrets(read_table(spark, folder, "documents"))


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    judged = quality.quality(docs, labels)
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "score", "kept")


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, folder, "documents"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(read_table(spark, folder, "documents")).drop("positions")


def op8_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_scan(read_table(spark, folder, "documents"), ["doc_id"]).drop("spans")


def op9_decontam(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark")
    return decontam.contamination(docs, benchmark, ["doc_id"]).drop("removal_spans")


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived(read_table(spark, folder, "pages"))


def op11_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(read_table(spark, folder, "documents")).drop("found")


def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(read_table(spark, folder, "documents"))


def op13_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(read_table(spark, folder, "conversations"))


def all_queries() -> dict:
    """Every query of this subpackage by name."""
    named = [op1_extraction, op2_suffix, op3_katz, op4_secrets, op5_quality, op6_simhash, op7_mixing, op8_licenses, op9_decontam, op10_warc, op11_pii, op12_merkle, op13_trie]
    return {f.__name__: f for f in named}
