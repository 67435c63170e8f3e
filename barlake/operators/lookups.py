"""Stored-table queries: ranges, cross-sections, latest dates and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from barlake.schemas import BAR_KEY

BASIC_COLUMNS = ("pe", "pb", "turnover_rate", "circ_mv", "total_mv")


MONTH = "trade_month"


def _date(value: str):
    return F.lit(value).cast("date")


def between_days(df: DataFrame, start: str, end: str, column: str = "trade_date") -> DataFrame:
    """Both ends included.  A stored table with its month column reads those months only."""
    first, last = _date(start), _date(end)
    rows = df.filter(F.col(column).between(first, last))
    if column != "trade_date" or MONTH not in df.columns:
        return rows
    return rows.filter(F.col(MONTH).between(F.date_format(first, "yyyy-MM"), F.date_format(last, "yyyy-MM")))


def on_day(df: DataFrame, trade_date: str) -> DataFrame:
    """One day; of a stored table with its month column only that month is read."""
    day = _date(trade_date)
    rows = df.filter(F.col("trade_date") == day)
    return rows.filter(F.col(MONTH) == F.date_format(day, "yyyy-MM")) if MONTH in df.columns else rows


def daily_range(bars: DataFrame, ts_code: str, start: str, end: str, columns: list[str] | None = None) -> DataFrame:
    """One instrument over a range of days, in date order."""
    rows = between_days(bars.filter(F.col("ts_code") == ts_code), start, end).orderBy("trade_date")
    return rows.select(*columns) if columns else rows


def with_basics(bars: DataFrame, basics: DataFrame) -> DataFrame:
    """Bars with their fundamentals of the day."""
    have = [c for c in BASIC_COLUMNS if c in basics.columns]
    return bars.join(basics.select(*BAR_KEY, *have), list(BAR_KEY), "left")


def cross_sections(bars: DataFrame, basics: DataFrame) -> DataFrame:
    """Bars with a positive close and their fundamentals, for all days."""
    return with_basics(bars.filter(F.col("close") > 0), basics)


def cross_section(bars: DataFrame, basics: DataFrame, trade_date: str) -> DataFrame:
    """One day of :func:`cross_sections`; day and month are filtered in both scans."""
    return cross_sections(on_day(bars, trade_date), on_day(basics, trade_date)).drop(MONTH)


def instruments_by_status(instruments: DataFrame, status: str = "L") -> DataFrame:
    return instruments.filter(F.col("list_status") == status).orderBy("ts_code")


def latest_date(bars: DataFrame, ts_code: str | None = None) -> DataFrame:
    rows = bars.filter(F.col("ts_code") == ts_code) if ts_code else bars
    return rows.agg(F.max("trade_date").alias("latest_date"))


def latest_date_by_stock(bars: DataFrame) -> DataFrame:
    return bars.groupBy("ts_code").agg(F.max("trade_date").alias("latest_date"))


def stock_count(bars: DataFrame, trade_date: str | None = None) -> DataFrame:
    rows = on_day(bars, trade_date) if trade_date else bars
    return rows.agg(F.count_distinct("ts_code").alias("stock_count"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, one output row each."""
    counted = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name, df in tables.items()]
    result = counted[0]
    for more in counted[1:]:
        result = result.unionByName(more)
    return result


def date_range(bars: DataFrame) -> DataFrame:
    return bars.agg(F.min("trade_date").alias("date_min"), F.max("trade_date").alias("date_max"))


def recent_trade_dates(calendar: DataFrame, as_of: str, n: int = 5) -> DataFrame:
    """Last n open days up to ``as_of``, newest first."""
    open_days = calendar.filter((F.col("is_open") == 1) & (F.col("trade_date") <= _date(as_of)))
    return open_days.select("trade_date").orderBy(F.desc("trade_date")).limit(n)


def recent_runs(log: DataFrame, n: int = 10) -> DataFrame:
    """Last n runs by run date; the run id decides between runs of one day."""
    return log.orderBy(F.desc("run_date"), F.desc("id")).limit(n)


def open_days_per_year(calendar: DataFrame) -> DataFrame:
    return calendar.groupBy(F.year("trade_date").alias("year")).agg(
        F.sum(F.col("is_open").cast("long")).alias("open_days")
    )


def raw_sql(spark: SparkSession, sql: str, params: list | dict | None = None) -> DataFrame:
    """A SQL text with bound parameters."""
    return spark.sql(sql, args=params) if params else spark.sql(sql)
