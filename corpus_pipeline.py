"""Corpus pipeline: five stages over ``documents``, each written and reread.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidpulse.llm import byte_bpe, digest_tree, mix_budget, quality_rules, simhash_trie
from vidpulse.llm.common import written

RANKS = "byte_bpe_multi_50k.tiktoken"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.passing(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays."""
    return digest_tree.deduplicate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component one document stays."""
    return simhash_trie.deduplicate(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mix_budget.mixed(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian uint32) of each document, checked by decoding."""
    ids = byte_bpe.encode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return ids.select(F.col("id").alias("doc_id"), "n_tokens", "ids", "ids_sha256", "round_trip")


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", near_dedup),
    ("mix_sources", mix),
    ("byte_bpe", tokenize),
]

#: BPE and SimHash have no SQL form; tests/llm compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; every stage but the last is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
