"""What each feed writes into which table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from barlake.functions.dates import calendar_parts
from barlake.operators.calendar import previous_open_day
from barlake.operators.quality import report_json
from barlake.schemas import (
    DAILY_BASIC,
    DAILY_KLINE,
    DATA_SOURCE_AUDIT,
    FINANCIAL_INDICATORS,
    PIPELINE_LOG,
    STOCK_LIST,
    STOCK_NAME_HISTORY,
    TRADE_CALENDAR,
)
from barlake.storage.tables import read_table, upsert

# The columns of the narrow bar upsert.
FIXED_BAR_COLUMNS = (
    "open", "high", "low", "close", "vol", "amount", "pct_chg", "adj_factor",
    "flag_extreme", "flag_suspended",
)


def upsert_bars(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    columns: list[str] | None = None,
    order: str | None = None,
    unique: bool = False,
) -> int:
    """Bars with whatever table columns the batch carries (or the listed ones)."""
    return upsert(spark, path, DAILY_KLINE, batch, columns, order, unique=unique)


def upsert_bars_fixed(spark: SparkSession, path: str, batch: DataFrame, order: str | None = None) -> int:
    """Bars with the fixed column list.  Without code, date or close nothing is written."""
    if not {"ts_code", "trade_date", "close"} <= set(batch.columns):
        return 0
    return upsert(spark, path, DAILY_KLINE, batch, list(FIXED_BAR_COLUMNS), order, FIXED_BAR_COLUMNS)


def upsert_daily_basic(spark: SparkSession, path: str, batch: DataFrame, order: str | None = None) -> int:
    """Fundamentals; the trailing price-earnings column is never loaded."""
    columns = [c for c in DAILY_BASIC.columns if c not in (*DAILY_BASIC.key, "pe_ttm")]
    return upsert(spark, path, DAILY_BASIC, batch, columns, order, tuple(columns))


def upsert_financials(spark: SparkSession, path: str, batch: DataFrame, order: str | None = None) -> int:
    """Quarterly indicators; two reports announced on one day share a key."""
    return upsert(spark, path, FINANCIAL_INDICATORS, batch, None, order, ("end_date",))


def upsert_name_history(spark: SparkSession, path: str, batch: DataFrame, order: str | None = None) -> int:
    return upsert(spark, path, STOCK_NAME_HISTORY, batch, None, order)


def upsert_source_audit(spark: SparkSession, path: str, batch: DataFrame, order: str | None = None) -> int:
    return upsert(spark, path, DATA_SOURCE_AUDIT, batch, None, order)


def upsert_calendar(spark: SparkSession, path: str, batch: DataFrame, order: str | None = None) -> int:
    """Calendar days with their attributes; a stored previous day is not changed."""
    full = batch if "pretrade_date" in batch.columns else batch.withColumn("pretrade_date", F.lit(None).cast("date"))
    return upsert(
        spark, path, TRADE_CALENDAR, full.withColumns(calendar_parts("trade_date")), None, order, keep=("pretrade_date",)
    )


def refresh_previous_days(spark: SparkSession, path: str) -> int:
    """Set the previous open day of every open day from the calendar as stored now."""
    stored = read_table(spark, path, TRADE_CALENDAR).select("trade_date", "is_open")
    known = previous_open_day(stored).filter("is_open = 1").select("trade_date", "pretrade_date")
    return upsert(spark, path, TRADE_CALENDAR, known, unique=True)


def upsert_instruments(spark: SparkSession, path: str, batch: DataFrame, loaded_at: str, order: str | None = None) -> int:
    """Instruments; attributes the list lacks are written as NULL.  The symbol and both
    time stamps are set on insert and stay."""
    optional = {"area": "string", "industry": "string", "list_date": "date", "delist_date": "date"}
    full = batch.withColumns(
        {c: F.lit(None).cast(kind) for c, kind in optional.items() if c not in batch.columns}
    ).withColumns({c: F.lit(loaded_at).cast("timestamp") for c in ("created_at", "updated_at")})
    return upsert(spark, path, STOCK_LIST, full, None, order, keep=("symbol", "created_at", "updated_at"))


def append_run_records(path: str, records: DataFrame) -> None:
    """Start and end records of runs; :func:`barlake.operators.runs.fold_run_log` folds them."""
    known = {c: F.col(c) if c in records.columns else F.lit(None) for c in PIPELINE_LOG.columns}
    rows = records.select(*[v.cast(PIPELINE_LOG.schema[c].dataType).alias(c) for c, v in known.items()])
    (
        rows.withColumn(PIPELINE_LOG.partition, PIPELINE_LOG.partition_value())
        .hint("rebalance", PIPELINE_LOG.partition)
        .write.mode("append")
        .partitionBy(PIPELINE_LOG.partition)
        .parquet(path)
    )


def save_reports(path: str, report: DataFrame) -> None:
    """Quality reports as JSON, one folder per day; days reported again are replaced."""
    (
        report_json(report)
        .withColumn("report_date", F.col("date"))
        .hint("rebalance", "report_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("report_date")
        .json(path)
    )
