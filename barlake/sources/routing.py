"""Putting batches together and choosing between sources."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def union_batches(*batches: DataFrame) -> DataFrame:
    """All batches in one frame; a column a batch lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def pick_by_priority(sources: dict[str, DataFrame]) -> DataFrame:
    """Per instrument, all rows of the first source (in dict order) that has any.

    The best priority per instrument is a partial aggregation of one small integer, and
    the join back is a plain equi-join: if landed copies pile up on one instrument,
    adaptive execution can split its side of the join."""
    tagged = [
        df.withColumns({"source": F.lit(name), "source_rank": F.lit(rank)})
        for rank, (name, df) in enumerate(sources.items())
    ]
    landed = union_batches(*tagged)
    best = landed.groupBy("ts_code").agg(F.min("source_rank").alias("source_rank"))
    return landed.join(best, ["ts_code", "source_rank"], "inner").drop("source_rank")


def fill_windows(
    requests: DataFrame, sources: dict[str, DataFrame], kept: Callable[[DataFrame, str], DataFrame] = lambda rows, name: rows
) -> DataFrame:
    """Bars for the requested windows, from the first source (in dict order) that covers each part.

    ``requests`` has ``ts_code``, ``start_date`` and ``end_date``, both days included; windows of one instrument do
    not overlap.  Within a window a source covers the days from its first to its last bar; what is left in
    front and behind is asked of the next source.  So every bar belongs to one window of one source, and no
    day has two sources.  ``kept(rows, name)`` may store what is still open after each source, so that later
    sources do not find it again."""
    still = requests.select("ts_code", F.col("start_date").alias("lo"), F.col("end_date").alias("hi")).filter("lo <= hi")
    found = []
    for name, bars in sources.items():
        inside = bars.join(still, "ts_code").filter(F.col("trade_date").between(F.col("lo"), F.col("hi")))
        found.append(inside.drop("lo", "hi").withColumn("source", F.lit(name)))
        covered = inside.groupBy("ts_code", "lo", "hi").agg(F.min("trade_date").alias("first"), F.max("trade_date").alias("last"))
        window = lambda a, b: F.struct(a.alias("lo"), b.alias("hi"))
        lo, hi, first, last = (F.col(c) for c in ("lo", "hi", "first", "last"))
        parts = F.array(
            F.when(first.isNull(), window(lo, hi)),
            F.when(first > lo, window(lo, F.date_sub(first, 1))),
            F.when(last < hi, window(F.date_add(last, 1), hi)),
        )
        left = still.join(covered, ["ts_code", "lo", "hi"], "left").select("ts_code", F.inline(F.array_compact(parts)))
        still = kept(left, name)
    return union_batches(*found)
