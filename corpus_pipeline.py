"""From raw documents to a tokenised training stream, in five stages.

Each stage takes (spark, docs, sf_dir) and returns the rows for the next one;
whoever runs them writes each result and reads it back.
"""

from __future__ import annotations

import os
import sys

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.llm import bpe, exact_dedup, mixing, near_dedup, quality_rules  # noqa: E402
from millrace.llm.queries import ENCODING_RANKS  # noqa: E402
from millrace.llm.text import small_batches  # noqa: E402
from millrace.workspace import fresh_path  # noqa: E402


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    small_batches(spark)
    return quality_rules.passing(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.drop_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    small_batches(spark)
    return near_dedup.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training stream: documents in order, each as often as the mix uses it."""
    return mixing.training_stream(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row of the stream, with the bytes they decode to."""
    small_batches(spark)
    ranks = bpe.read_ranks(public_tokenizers.path(ENCODING_RANKS))
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded=True)
    return encoded.selectExpr("id AS doc_id", "n_tokens", "token_ids", "CAST(decoded AS STRING) AS text")


STAGES = [
    ("quality_rules", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("byte_bpe", encoding_stage),
]

# SQL cannot express the encoding; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
