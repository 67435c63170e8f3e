"""From raw documents to packed sequences: quality rules, near-duplicates, personal data, packing.

Every stage takes all documents that the one before kept, and writes its result as a Parquet
table that the next one reads; so a lost executor costs tasks, not stages.  All stages but the
last return the columns of ``documents``.

Nulls, empty texts, ties, repeated rows, empty tables and extra columns: see the operators.  A
null text has no words, so the quality rules drop it before the later stages see it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barlake.llm import packing, pii, quality, simhash
from barlake.llm.common import saved, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or are outliers of their language and source."""
    return quality.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of every group of near copies."""
    return simhash.one_of_each(docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by pseudonyms."""
    return pii.private(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents' tokens and their places in the training sequences."""
    return packing.packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("personal data", private_data),
    ("packing", packed),
]

# Hash functions, iterated estimates and tokenizers have no counterpart in the SQL of the checks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"corpus-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
