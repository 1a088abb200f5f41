"""Documents to clean, deduplicated, decontaminated, redacted and encoded documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import byte_bpe, decontaminate, language_id, secret_scan, simhash
from tidemark.llm.common import materialise, on_workers, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or too far from every learned language go."""
    on_workers(spark)
    return language_id.keep_known(docs, language_id.learn_from(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id."""
    on_workers(spark)
    return simhash.keep_one(docs, words=4, bits=4)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words inside benchmark windows are cut out of the texts."""
    on_workers(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Values of owner-specific credentials are masked, with or without a digit; copied examples stay."""
    return secret_scan.redact(docs)


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and their digests."""
    on_workers(spark)
    return byte_bpe.digests(byte_bpe.round_trip(docs, public_tokenizers.path(byte_bpe.RANKS)))


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", remove_benchmark),
    ("secret_scans", redact_secrets),
    ("byte_bpe", encode_bytes),
]

#: Learned centroids and connected components are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
