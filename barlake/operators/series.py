"""Operations on one instrument's date-ordered series."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F
from pyspark.sql.types import IntegralType

from barlake.functions.columns import ratio, true_only


def by_day() -> WindowSpec:
    return Window.partitionBy("ts_code").orderBy("trade_date")


def so_far() -> WindowSpec:
    return by_day().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def whole_series() -> WindowSpec:
    return by_day().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


# price columns that carry over a gap; volume, turnover and factors do not
FILLED_COLUMNS = (
    "open", "high", "low", "close",
    "adj_open", "adj_high", "adj_low", "adj_close",
    "raw_open", "raw_high", "raw_low", "raw_close",
)


def dedup_first(
    df: DataFrame, keys: Iterable[str] = ("ts_code", "trade_date"), order: str = "ingest_seq"
) -> DataFrame:
    """One row per key: the one that arrived first.

    ``order`` must not repeat within a key; rows without one come last.  An aggregation
    rather than ``row_number``: map tasks reduce their copies of a key to one row before
    anything is shuffled."""
    keys = list(keys)
    others = [c for c in df.columns if c not in keys and c != order]
    if isinstance(df.schema[order].dataType, IntegralType):
        arrival = F.coalesce(F.col(order).cast("long"), F.lit((1 << 63) - 1))
    else:
        arrival = F.struct(F.col(order).isNull(), F.col(order))
    first = df.groupBy(*keys).agg(
        *[F.min_by(F.col(c), arrival).alias(c) for c in others], F.min(order).alias(order)
    )
    return first.select(*df.columns)


def last_known(column: Column | str) -> Column:
    """Forward fill: the latest non-NULL value up to this row."""
    return F.last(column, ignorenulls=True).over(so_far())


def forward_fill(df: DataFrame, columns: Iterable[str] = FILLED_COLUMNS) -> DataFrame:
    return df.withColumns({c: last_known(c) for c in columns if c in df.columns})


def fill_both_ways(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Forward fill, then backward fill.

    After the forward pass only leading NULLs are left, and all of them take the first
    known value of the series; a whole-series frame gives that in one sweep, where a
    frame running to the end of the series would be rescanned for every row."""
    return df.withColumns(
        {c: F.coalesce(last_known(c), F.first(c, ignorenulls=True).over(whole_series())) for c in columns}
    )


def returns(df: DataFrame) -> DataFrame:
    """``pct_chg`` in percent and ``log_ret`` against the previous row.

    A previous close of zero gives NULL for both (see :func:`flag_extreme` for the flag)."""
    previous = F.lag("close").over(by_day())
    step = ratio(F.col("close"), previous)
    return df.withColumns({"pct_chg": (step - 1) * 100, "log_ret": F.ln(step)})


def zero_aligned_returns(df: DataFrame) -> DataFrame:
    aligned = true_only(F.col("flag_aligned"))
    return df.withColumns(
        {c: F.when(aligned, F.lit(0.0)).otherwise(F.col(c)) for c in ("pct_chg", "log_ret")}
    )


def flag_suspended(df: DataFrame) -> DataFrame:
    """No volume: NULL or zero.  Without a volume column nothing is suspended."""
    halted = F.coalesce(F.col("vol"), F.lit(0.0)) == 0 if "vol" in df.columns else F.lit(False)
    return df.withColumn("flag_suspended", halted)


def flag_extreme(df: DataFrame, max_daily_pct: float = 15.0) -> DataFrame:
    """A move beyond the threshold, in either direction.

    A rise from a zero close has no finite return; it counts as extreme where the
    previous close is at hand, except on rows the calendar added (return 0)."""
    flag = true_only(F.abs("pct_chg") > max_daily_pct)
    if "close" in df.columns:
        from_zero = (F.lag("close").over(by_day()) == 0) & (F.col("close") != 0)
        flag = flag | true_only(F.col("pct_chg").isNull() & from_zero)
    return df.withColumn("flag_extreme", flag)


def invalid_ohlc() -> Column:
    """Prices that contradict each other or are not positive; unknown prices never do.

    ``greatest`` and ``least`` skip NULLs; a comparison that stays unknown counts as false."""
    terms = (
        "high < greatest(open, close, low)",
        "low > least(open, close, high)",
        "least(open, high, low, close) <= 0",
    )
    return F.expr(" OR ".join(f"coalesce({term}, false)" for term in terms))


def flag_invalid_ohlc(df: DataFrame) -> DataFrame:
    """Mark contradictory prices without changing them; such rows are extreme as well."""
    if not {"open", "high", "low", "close"} <= set(df.columns):
        return df
    marked = df.withColumn("flag_invalid_ohlc", invalid_ohlc())
    if "flag_extreme" not in df.columns:
        return marked.withColumn("flag_extreme", F.col("flag_invalid_ohlc"))
    return marked.withColumn(
        "flag_extreme", true_only(F.col("flag_extreme")) | F.col("flag_invalid_ohlc")
    )


def flag_listed_codes(
    df: DataFrame, codes: DataFrame | list[str] | None, name: str = "is_st"
) -> DataFrame:
    """Rows whose instrument is in a list.  No list: nothing is flagged.

    A Python list becomes an ``IN`` predicate; a table becomes an equi-join whose build
    side Spark chooses by size."""
    if codes is None:
        return df.withColumn(name, F.lit(False))
    if isinstance(codes, list):
        return df.withColumn(name, true_only(F.col("ts_code").isin(codes)))
    listed = codes.select("ts_code").distinct().withColumn(name, F.lit(True))
    return df.join(listed, "ts_code", "left").withColumn(name, true_only(F.col(name)))
