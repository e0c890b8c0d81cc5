"""A corpus pipeline of the training-data operators; every stage reads what its predecessor kept."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from hitscope.llm import byte_bpe, dart_minhash, decontamination, language_id, line_dedup
from hitscope.llm.common import shared_folder, table


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return language_id.keep_identified(docs)


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each without the lines that an earlier one holds; ``n_chars`` follows the text."""
    kept = line_dedup.line_dedup(docs, counts=False)
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-duplicates."""
    return dart_minhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each text, encoded and decoded again."""
    return byte_bpe.bpe_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", identified),
    ("line_dedup", without_shared_lines),
    ("near_dedup", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("byte_bpe", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet to the shared folder and read again."""
    folder = shared_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        path = f"{folder}/{number}-{name}"
        result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
    return docs


#: Trained networks and near-duplicate groups are beyond SQL.
ORACLE_SQL = None
