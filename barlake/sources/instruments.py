"""Instrument lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from barlake.functions.codes import exchange_of, ts_code_of, zero_pad
from barlake.functions.dates import day


def union_listed_delisted(listed: DataFrame, delisted: DataFrame) -> DataFrame:
    """Both lists in one, with status.  A code in both lists yields two rows, both ``D``."""
    gone = delisted.select("ts_code").distinct().withColumn("gone", F.lit(True))
    both = listed.unionByName(delisted, allowMissingColumns=True)
    dates = {
        c: day(F.col(c).cast("string")) if c in both.columns else F.lit(None).cast("date")
        for c in ("list_date", "delist_date")
    }
    return (
        both.join(gone, "ts_code", "left")
        .withColumns({"list_status": F.when(F.col("gone"), "D").otherwise("L"), **dates})
        .drop("gone")
    )


def from_bare_codes(codes: DataFrame) -> DataFrame:
    """Instruments from a list of (``code``, ``name``); codes of no known exchange are dropped."""
    symbol = zero_pad("code", 6)
    return (
        codes.select(symbol.alias("symbol"), "name")
        .withColumn("exchange", exchange_of("symbol"))
        .filter(F.col("exchange").isNotNull())
        .select(
            ts_code_of("symbol").alias("ts_code"),
            "symbol",
            "name",
            "exchange",
            F.lit("L").alias("list_status"),
            F.lit(None).cast("date").alias("list_date"),
            F.lit(None).cast("date").alias("delist_date"),
        )
    )
