"""Balanced shards by sampled splitters.

Documents are ordered by ``doc_id`` and cut into ranges at the quantiles of a sample of keys in
which a key's chance grows with its size.  The sample only has to be roughly right: the exact
sizes of the many ranges are then added up, and every range that a shard boundary falls into,
or that is larger than a shard, is subdivided at the very record where the boundary lies.  So
the shards are contiguous in key order and their sizes differ by no more than about one
document, whatever the sample.

Equal keys are ordered by the place where they were first stored, so a key that occurs very
often is sampled and subdivided like any other range.  The order is that of ids: equal texts under different ids
go to different shards, and equal rows stay neighbours.  A null ``doc_id`` sorts first; a null text has size 1; of very long texts
only size and checksum are taken; an empty table gives an empty result; only ``doc_id`` and ``text`` are read."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.common import on_workers, saved

SHARDS = 16
#: Keys in the sample, and records that a range should hold; the ranges are at most as many as the sample.
SAMPLE = 16_384
RANGE_ROWS = 20_000
LEAST_RANGES = 256


def _range_of(splitters: list[tuple[int, int]], key: Column, uid: Column) -> Column:
    """Number of the range of (key, uid), by binary search."""
    keys = np.array([k for k, _ in splitters], dtype=np.int64)
    uids = np.array([u for _, u in splitters], dtype=np.int64)

    @F.pandas_udf("int")
    def run(key: pd.Series, uid: pd.Series) -> pd.Series:
        k, u = key.to_numpy(np.int64), uid.to_numpy(np.int64)
        low = np.searchsorted(keys, k, side="left")
        high = np.searchsorted(keys, k, side="right")
        for i in np.flatnonzero(high > low):  # the key is a splitter itself
            low[i] += np.searchsorted(uids[low[i] : high[i]], u[i], side="right")
        return pd.Series(low.astype(np.int32))

    return run(key, uid)


def splitters(rows: DataFrame, ranges: int, sample: int = SAMPLE) -> list[tuple[int, int]]:
    """Boundaries between ``ranges`` ranges of near-equal size: quantiles of a weighted sample
    without replacement (exponential draws divided by size, the least ones win)."""
    draw = (F.xxhash64("key", "uid", F.lit(7)).cast("double") + 2.0**63) / 2.0**64
    race = -F.log(F.greatest(draw, F.lit(1e-300))) / F.col("size")
    drawn = rows.select("key", "uid", race.alias("race")).orderBy("race", "key", "uid").limit(sample)
    keys = sorted((r["key"], r["uid"]) for r in drawn.collect())  # bounded by ``sample``
    return [keys[len(keys) * i // ranges] for i in range(1, ranges)] if len(keys) >= ranges else keys


def assigned(docs: DataFrame, shards: int = SHARDS, sample: int = SAMPLE) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (from 0 within the shard) of every document."""
    on_workers(docs.sparkSession)
    data = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("key"),
        F.monotonically_increasing_id().alias("uid"),
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
    )
    rows = saved(rows, "sizes")  # fixes uid; texts are not needed any more
    n = rows.count()
    ranges = int(min(max(LEAST_RANGES, n // RANGE_ROWS), sample))
    ranged = rows.withColumn("range", _range_of(splitters(rows, ranges, sample), F.col("key"), F.col("uid")))
    order = Window.partitionBy("range").orderBy("key", "uid")
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.select(
        "*", F.coalesce(F.sum("size").over(upto), F.lit(0)).alias("before"), (F.row_number().over(order) - 1).alias("place")
    )
    placed = saved(placed, "ranges")
    # one row per range: where it begins in the whole order
    each = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    running = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    starts = each.select(
        "range",
        F.coalesce(F.sum("bytes").over(running), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n").over(running), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(every).alias("total"),
    )
    at = (F.col("bytes_before") + F.col("before")) * 2 + F.col("size")  # twice the record's middle
    shard = F.floor(at.cast("decimal(38,0)") * shards / (2 * F.col("total")).cast("decimal(38,0)"))
    cut = placed.join(F.broadcast(starts) if ranges <= SAMPLE else starts, "range").select(
        "doc_id", "size", "text_crc32", F.least(shard, F.lit(shards - 1)).cast("int").alias("shard"),
        (F.col("rows_before") + F.col("place")).alias("rank"),
    )
    cut = saved(cut, "cut")
    first = cut.groupBy("shard").agg(F.min("rank").alias("first"))  # a row per shard
    placed = cut.join(F.broadcast(first), "shard")
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("rank") - F.col("first")).alias("slot"))


def by_bytes(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``assigned`` with the law it keeps: shards of near-equal bytes."""
    found = assigned(docs, shards)
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
