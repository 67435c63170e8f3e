"""Tabular vendor frames: localised headers, date strings, other units."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from barlake.functions.codes import ts_code_of
from barlake.functions.columns import number
from barlake.functions.dates import day

# Localised column header -> bar column.
LOCALISED_HEADERS = {
    "日期": "trade_date",
    "开盘": "open",
    "最高": "high",
    "最低": "low",
    "收盘": "close",
    "成交量": "vol",
    "成交额": "amount",
    "振幅": "amplitude",
    "涨跌幅": "pct_chg",
    "涨跌额": "price_change",
    "换手率": "turnover_rate",
}
# CNY per unit of turnover in the feed that reports thousands.
THOUSAND_CNY = 1000

REQUIRED = ("trade_date", "open", "close", "vol")


def _empty_like(df: DataFrame) -> DataFrame:
    return df.filter(F.lit(False))


def localized_bars(frame: DataFrame) -> DataFrame:
    """Rename localised headers, cast, add ``ts_code``.  ``frame`` has a ``symbol`` column.

    A frame without date, open, close or volume yields no rows."""
    bars = frame.withColumnsRenamed({k: v for k, v in LOCALISED_HEADERS.items() if k in frame.columns})
    if any(c not in bars.columns for c in REQUIRED):
        return _empty_like(bars)
    numeric = [c for c in bars.columns if c not in ("symbol", "trade_date", "ts_code") and c in LOCALISED_HEADERS.values()]
    return bars.withColumns(
        {"trade_date": day(F.col("trade_date").cast("string")), **{c: number(c) for c in numeric}}
    ).withColumn("ts_code", ts_code_of("symbol")).drop("symbol")


def read_localized_bars(spark: SparkSession, path: str) -> DataFrame:
    """CSV files with localised headers and a ``symbol`` column; all columns read as text.

    Files whose header differs from the first one's in names or order are refused, not read
    into the wrong columns."""
    return localized_bars(spark.read.csv(path, header=True, enforceSchema=False))


def dated_string_bars(frame: DataFrame) -> DataFrame:
    """Daily frame with ``YYYYMMDD`` dates and turnover in thousands."""
    changes = {"trade_date": day("trade_date")}
    if "amount" in frame.columns:
        changes["amount"] = number("amount") * THOUSAND_CNY
    return frame.withColumns(changes)


def adjustment_factors(frame: DataFrame) -> DataFrame:
    return frame.select("ts_code", day("trade_date").alias("trade_date"), F.col("adj_factor").cast("double").alias("adj_factor"))


def calendar_feed(frame: DataFrame) -> DataFrame:
    """``cal_date`` strings and open marks to ``trade_date`` and integer ``is_open``."""
    return frame.withColumns({"trade_date": day("cal_date"), "is_open": F.col("is_open").cast("int")}).drop("cal_date")


BASIC_FEED_COLUMNS = ("ts_code", "trade_date", "pe", "pb", "turnover_rate", "volume_ratio", "circ_mv", "total_mv")


def daily_basics(frame: DataFrame) -> DataFrame:
    return frame.select(*BASIC_FEED_COLUMNS).withColumn("trade_date", day("trade_date"))


def financials(frame: DataFrame) -> DataFrame:
    """Quarterly indicators, keyed by announcement day.

    Row order is the reader's business: sort on output with ``orderBy("ann_date")``."""
    return frame.withColumns({"ann_date": day("ann_date"), "end_date": day("end_date")}).withColumnsRenamed(
        {"dt_debt_to_assets": "dt_debt_ratio"}
    )


def name_history(frame: DataFrame) -> DataFrame:
    """Name intervals with dates parsed (unparsable: NULL) and the ST mark.

    A name is ST if it or the reason of the change contains ``ST`` in any case."""
    mentions = lambda c: F.upper(F.coalesce(c, F.lit(""))).contains("ST")
    return frame.withColumns(
        {
            "start_date": day("start_date"),
            "end_date": day("end_date"),
            "is_st": mentions(F.col("name")) | mentions(F.col("change_reason")),
        }
    )
