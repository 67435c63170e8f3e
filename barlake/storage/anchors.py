"""Forward-adjusted prices of the stored bars.

The bar table stores prices and cumulative factors.  A forward-adjusted price is price x factor /
last factor of the instrument, so one new factor changes all earlier adjusted prices of its
instrument.  They are therefore not stored but derived when bars are read, from a small table
with one row per instrument: its latest day and its last factor.  A new factor changes one row
there and no older file of bars.

The same table is a directory of the bars: an instrument's first day and the months in which it has
bars.  So the last bar before a day is found without looking into every month.

The table of anchors is written after the bars.  Where a run breaks off in between, its
instruments still count as behind, so the next run reads their window again and sets their row.
An empty table of anchors says nothing is known; it is then made from the bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from barlake.functions.columns import ratio
from barlake.operators.lookups import MONTH
from barlake.schemas import BAR_DIRECTORY, DAILY_KLINE, PRICES, QFQ_PRICES
from barlake.storage.tables import init_table, read_table, write_partitions


def anchors_path(path: str) -> str:
    return f"{path.rstrip('/')}__anchors"


def read_directory(spark: SparkSession, path: str) -> DataFrame:
    """A row per instrument of the bars at ``path``, as last saved (see ``BAR_DIRECTORY``)."""
    init_table(spark, anchors_path(path), BAR_DIRECTORY)
    return read_table(spark, anchors_path(path), BAR_DIRECTORY).select(*BAR_DIRECTORY.columns)


def read_anchors(spark: SparkSession, path: str) -> DataFrame:
    """(``ts_code``, ``latest_date``, ``last_factor``) of the bars at ``path``, as last saved."""
    return read_directory(spark, path).select("ts_code", "latest_date", "last_factor")


def anchors_of(bars: DataFrame) -> DataFrame:
    """The directory of ``bars``: one aggregation over three columns."""
    known = F.when(F.col("adj_factor").isNotNull(), F.col("trade_date"))
    month = F.col(MONTH) if MONTH in bars.columns else F.date_format("trade_date", "yyyy-MM")
    return bars.groupBy("ts_code").agg(
        F.min("trade_date").alias("first_date"),
        F.max("trade_date").alias("latest_date"),
        F.max_by("adj_factor", known).alias("last_factor"),
        F.array_sort(F.collect_set(month)).alias("months"),
    )


def save_anchors(spark: SparkSession, path: str, anchors: DataFrame) -> DataFrame:
    """Replace the table in one step; the new rows may come from the old ones."""
    init_table(spark, anchors_path(path), BAR_DIRECTORY)
    write_partitions(anchors, anchors_path(path), BAR_DIRECTORY)
    return read_directory(spark, path)


def current_directory(spark: SparkSession, path: str) -> DataFrame:
    """The saved directory, or one made from all bars if none is there."""
    saved = read_directory(spark, path)
    return save_anchors(spark, path, anchors_of(read_table(spark, path, DAILY_KLINE))) if saved.isEmpty() else saved


def current_anchors(spark: SparkSession, path: str) -> DataFrame:
    return current_directory(spark, path).select("ts_code", "latest_date", "last_factor")


def with_adjusted_prices(bars: DataFrame, anchors: DataFrame) -> DataFrame:
    """``bars`` with ``adj_*_qfq`` from their factors; instruments without an anchor keep what is stored."""
    known = anchors.select("ts_code", "last_factor", F.lit(True).alias("anchored"))
    derived = {
        target: F.when(F.col("anchored"), ratio(F.col(p) * F.col("adj_factor"), F.col("last_factor"))).otherwise(F.col(target))
        for p, target in zip(PRICES, QFQ_PRICES)
    }
    return bars.join(known, "ts_code", "left").withColumns(derived).select(*bars.columns)


def read_adjusted(spark: SparkSession, path: str) -> DataFrame:
    """The stored bars with their forward-adjusted prices."""
    return with_adjusted_prices(read_table(spark, path, DAILY_KLINE), read_anchors(spark, path))
