"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.session import scratch_path

#: Words are runs of anything but ASCII white space; ``bytes.split()`` splits the same way.
WORD = r"[^\x20\x09-\x0D]+"
#: Texts are handed to the tokenizers in groups of about so many characters.
GROUP_CHARS = 1 << 20


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package where it is not installed on them."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known.get("PYTHONPATH", "")]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: read twice without being computed
    twice, the same on every attempt, and still there when executors are lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def grouped(rows, size, limit: int = GROUP_CHARS):
    """Lists of consecutive rows whose sizes add up to about ``limit``; one long row is a list of its own."""
    group, total = [], 0
    for row in rows:
        n = size(row)
        if group and total + n > limit:
            yield group
            group, total = [], 0
        group.append(row)
        total += n
    if group:
        yield group


def arrow_rows(batches, *names: str):
    """Rows of Arrow batches as tuples, a few at a time so that a batch is never wholly in Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            yield from zip(*(part.column(part.schema.get_field_index(n)).to_pylist() for n in names))


#: A key with more than one in so many of all rows is hot; there are fewer hot keys than this.
HOT_ONE_IN = 1000
#: The place within its partition is in so many low bits of ``monotonically_increasing_id``.
PLACE_BITS = 33


def join_named(rows: DataFrame, named: DataFrame, key: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``named``, which has each key once and, as ``n``, how many of the
    ``total`` rows have it.  The few hot keys, fewer than ``HOT_ONE_IN`` whatever the size, are
    broadcast, so that no task of the shuffled join gets all rows of one of them."""
    hot = F.col("n") * HOT_ONE_IN > total
    often = F.broadcast(named.filter(hot))
    rest = rows.join(often.select(key), key, "left_anti").join(named.filter(~hot), key)
    return rows.join(often, key).unionByName(rest)


def numbered_in(rows: DataFrame, chosen: DataFrame, number: str) -> DataFrame:
    """The ``rows`` whose ``number`` is among the ``chosen``; numbers are those of ``monotonically_increasing_id``.

    One bit for each place of a partition is broadcast, in bitmaps of 4 KB, so the rows are not shuffled."""
    bucket = F.bitmap_bucket_number(number).alias("bucket")
    dealt = chosen.select(number, bucket).repartition("bucket")  # each bitmap is built by one task
    bits = dealt.groupBy("bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))
    place = F.bitmap_bit_position(number)
    byte = F.conv(F.hex(F.substring("bits", F.shiftright(place, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = byte.bitwiseAND(F.expr(f"shiftleft(1, CAST(bitmap_bit_position({number}) % 8 AS INT))")) != 0
    return rows.withColumn("bucket", bucket).join(F.broadcast(bits), "bucket").filter(bit).select(*rows.columns)


def numbered(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` as a saved table with ``number``, 0, 1, 2... in ``order``: sorted in ranges, each
    range's numbers starting where those of the ranges before it end."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged = saved(ranged.withColumn("at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("at", PLACE_BITS).alias("part")
    sizes = ranged.groupBy(part).agg(F.count(F.lit(1)).alias("n"))  # a row per partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.col("at").bitwiseAND((1 << PLACE_BITS) - 1)
    found = ranged.withColumn("part", part).join(F.broadcast(starts), "part")
    return found.withColumn("number", F.col("start") + place).drop("at", "part", "start")
