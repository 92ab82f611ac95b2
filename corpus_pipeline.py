"""Documents to packed sequences: quality rules, exact dedup, near-dedup, packing."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import dedup, packing, quality, simhash
from tidemark.llm.shared import read_table
from tidemark.sources.scratch import scratch_path, settle


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.drop_low_quality(docs, read_table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dedup.drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end=1)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("packing", packed),
]
# Cutoffs, fingerprints and tokens are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each one's rows are written as Parquet and read by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), scratch_path(spark))
    return docs
