"""The operators as queries on the given tables, and their SQL."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from hitscope.llm import (
    byte_bpe,
    dart_minhash,
    decontamination,
    hard_negatives,
    language_id,
    line_dedup,
    merkle,
    nearest,
    pii,
    quality,
    simhash,
    substring_dedup,
    suffix_dedup,
)
from hitscope.llm.common import table


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    return kept.select("doc_id", "n_lines", "n_dropped", digest)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.bpe_digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a key for trials; a real one is a secret that the caller passes."""
    return pii.pseudonymise_documents(table(spark, sf_dir, "documents"), b"key for trials only")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    return kept.select("doc_id", "n_words", "n_removed", digest)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_manifest(table(spark, sf_dir, "documents"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_nearest": op1_nearest,
    "op2_decontamination": op2_decontamination,
    "op3_line_dedup": op3_line_dedup,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_quality": op5_quality,
    "op6_dart_minhash": op6_dart_minhash,
    "op7_pii": op7_pii,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_language_id": op10_language_id,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_simhash": op13_simhash,
}

ORACLE_SQL = {
    "op3_line_dedup": line_dedup.ORACLE_SQL,
    "op8_suffix_dedup": suffix_dedup.ORACLE_SQL,
    "op9_substring_dedup": substring_dedup.ORACLE_SQL,
    "op11_hard_negatives": hard_negatives.ORACLE_SQL,
    "op12_merkle_manifest": merkle.ORACLE_SQL,
}
