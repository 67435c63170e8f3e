"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm import bpe, nearest, packing, pii, planes, quality, repair, resampling, shards, simhash, substrings, urls, wordpiece
from barlake.llm.common import table
from barlake.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.token_counts(table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.document_verdicts(table(spark, sf_dir, "documents"))


def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replaced(table(spark, sf_dir, "documents"))


def op6_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "bit-planes")
    planes.write(table(spark, sf_dir, "documents"), path)
    return planes.digests(spark, path)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest.search(vectors, F.col("vec_id") % 20 == 0)


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.by_bytes(table(spark, sf_dir, "documents"))


def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair.digests(conversations, repair.edits(repair.damaged(conversations)))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_byte_bpe, op3_packing, op4_quality, op5_pseudonyms, op6_bit_planes, op7_simhash,
        op8_url_filter, op9_nearest, op10_shards, op11_repeats, op12_repair, op13_resampling,
    )
}
