"""Who could be traded on which day, and why not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barlake.functions.codes import SUFFIX_BY_EXCHANGE
from barlake.functions.columns import true_only
from barlake.operators.lookups import on_day
from barlake.schemas import BAR_KEY

META_COLUMNS = ("name", "exchange", "area", "industry", "list_date", "delist_date", "list_status")
OPEN_END = "9999-12-31"


# --- name-history intervals -----------------------------------------------------------


def _closed_end() -> Column:
    return F.coalesce(F.col("end_date"), F.lit(OPEN_END).cast("date"))


def merged_st_intervals(history: DataFrame) -> DataFrame:
    """Disjoint ST periods per instrument: overlapping or touching intervals become one.

    Intervals with the same start collapse in a partial aggregation first, so the
    windows see at most one row per instrument and day."""
    starts = (
        history.filter(F.col("is_st") & (_closed_end() >= F.col("start_date")))
        .groupBy("ts_code", "start_date")
        .agg(F.max(_closed_end()).alias("end_date"))
    )
    in_order = Window.partitionBy("ts_code").orderBy("start_date")
    reach = F.max("end_date").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.datediff("start_date", "reach") <= 1, 0).otherwise(1)
    return (
        starts.withColumn("reach", reach)
        .withColumn("period", F.sum(opens).over(in_order))
        .groupBy("ts_code", "period")
        .agg(F.min("start_date").alias("st_from"), F.max("end_date").alias("st_to"))
        .select("ts_code", "st_from", "st_to")
    )


def with_st_on_date(bars: DataFrame, history: DataFrame) -> DataFrame:
    """``is_st_on_date``: does any ST interval of the instrument cover the day?

    Merged periods are disjoint, so a bar meets at most one of them: the left join keeps
    the number of rows, needs no aggregation behind it, and lets a filter on the day
    reach the bar scan."""
    periods = merged_st_intervals(history).withColumnRenamed("ts_code", "st_code")
    covers = (F.col("ts_code") == F.col("st_code")) & F.col("trade_date").between(F.col("st_from"), F.col("st_to"))
    return (
        bars.join(periods, covers, "left")
        .withColumn("is_st_on_date", F.col("st_code").isNotNull())
        .drop("st_code", "st_from", "st_to")
    )


def count_covering_intervals(bars: DataFrame, history: DataFrame) -> DataFrame:
    """How many name intervals, and how many ST ones, cover each bar.

    The interval join is evaluated as a sweep: +1 where an interval opens, -1 on the day
    after it closes, running total by day.  Openings and closings of a day are summed up
    before the shuffle.  No (bar, interval) pair is ever built, so long overlapping
    histories cost no more than short ones."""
    valid = history.filter(_closed_end() >= F.col("start_date")).withColumn(
        "st", F.when(true_only(F.col("is_st")), 1).otherwise(0)
    )
    steps = F.array(
        F.struct(F.col("start_date").alias("trade_date"), F.lit(1).alias("n"), F.col("st").alias("n_st")),
        F.struct(
            F.date_add("end_date", 1).alias("trade_date"), F.lit(-1).alias("n"), (-F.col("st")).alias("n_st")
        ),
    )
    changes = (
        valid.select("ts_code", F.inline(steps))
        .filter(F.col("trade_date").isNotNull())
        .groupBy(*BAR_KEY)
        .agg(F.sum("n").alias("n"), F.sum("n_st").alias("n_st"))
        .withColumn("is_bar", F.lit(False))
    )
    points = bars.select(*BAR_KEY, F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("n_st"), F.lit(True).alias("is_bar"))
    up_to_day = (
        Window.partitionBy("ts_code").orderBy("trade_date").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        points.unionByName(changes)
        .withColumns({"n_intervals": F.sum("n").over(up_to_day), "n_st_intervals": F.sum("n_st").over(up_to_day)})
        .filter("is_bar")
        .select(*BAR_KEY, "n_intervals", "n_st_intervals")
    )


# --- the daily universe -----------------------------------------------------------------


def with_instrument_meta(bars: DataFrame, instruments: DataFrame) -> DataFrame:
    """Left lookup by instrument; ``has_meta`` tells a miss from NULL attributes."""
    meta = instruments.select("ts_code", *META_COLUMNS).withColumn("has_meta", F.lit(True))
    return bars.join(meta, "ts_code", "left").withColumn("has_meta", true_only(F.col("has_meta")))


def _before_listing() -> Column:
    return F.col("trade_date") < F.col("list_date")


def _after_delisting() -> Column:
    return F.col("trade_date") >= F.col("delist_date")


def exclude_reason() -> Column:
    """First reason, in fixed order, that keeps a row out; NULL if there is none."""
    ordered = [
        ("missing_stock_meta", ~F.col("has_meta")),
        ("pre_list", _before_listing()),
        ("delisted", _after_delisting()),
        ("historical_st", F.col("is_st_on_date")),
        ("suspended", F.col("flag_suspended")),
        ("calendar_aligned", F.col("flag_aligned")),
        ("invalid_ohlc", F.col("flag_invalid_ohlc")),
        ("extreme", F.col("flag_extreme")),
        ("invalid_close", (F.col("close") <= 0) | F.col("close").isNull()),
    ]
    chain = F
    for reason, condition in ordered:
        chain = chain.when(condition, F.lit(reason))
    return chain.otherwise(F.lit(None))


def is_in_universe() -> Column:
    """Three-valued: an unknown close leaves the answer unknown unless something else
    already says no.  Missing metadata alone does not exclude."""
    clean = ~true_only(F.col("is_st_on_date"))
    for flag in ("flag_suspended", "flag_aligned", "flag_invalid_ohlc", "flag_extreme"):
        clean = clean & ~true_only(F.col(flag))
    return clean & ~true_only(_before_listing()) & ~true_only(_after_delisting()) & (F.col("close") > 0)


def research_universe(bars: DataFrame, instruments: DataFrame, history: DataFrame) -> DataFrame:
    """All bars with metadata, ST status of the day, membership and exclusion reason."""
    judged = with_st_on_date(with_instrument_meta(bars, instruments), history)
    listed = ~true_only(_before_listing()) & ~true_only(_after_delisting())
    return judged.withColumns(
        {"is_listed_on_date": listed, "is_in_universe": is_in_universe(), "exclude_reason": exclude_reason()}
    ).drop("has_meta")


def universe_on(universe: DataFrame, trade_date: str, only_in_universe: bool = True) -> DataFrame:
    """One day of the universe, ordered by instrument."""
    day = on_day(universe, trade_date)
    return (day.filter("is_in_universe") if only_in_universe else day).orderBy("ts_code")


# --- the current pool --------------------------------------------------------------------


def stock_pool(
    instruments: DataFrame,
    as_of: str,
    include_exchanges: list[str] | None = None,
    exclude_st: bool = True,
    exclude_ipo_within_days: int = 60,
    head: int | None = None,
) -> DataFrame:
    """Codes to collect: wanted exchanges, listed, not ST by name, listed long enough.

    Unknown listing dates pass.  Exchange names nobody knows select nothing.  ``head``
    keeps the first codes of the ordered pool (test mode)."""
    pool = instruments
    if include_exchanges:
        wanted = [SUFFIX_BY_EXCHANGE[e] for e in include_exchanges if e in SUFFIX_BY_EXCHANGE]
        in_market = F.lit(False)
        for suffix in wanted:
            in_market = in_market | F.col("ts_code").endswith(f".{suffix}")
        pool = pool.filter(in_market)
    pool = pool.filter(F.col("list_status") == "L")
    if exclude_st and "name" in pool.columns:
        pool = pool.filter(~F.upper(F.coalesce("name", F.lit(""))).contains("ST"))
    if exclude_ipo_within_days and "list_date" in pool.columns:
        cutoff = F.date_sub(F.lit(as_of).cast("date"), exclude_ipo_within_days)
        pool = pool.filter(F.col("list_date").isNull() | (F.col("list_date") <= cutoff))
    codes = pool.select("ts_code")
    return head_codes(codes, head) if head is not None else codes


def head_codes(codes: DataFrame, n: int) -> DataFrame:
    """First n codes in code order."""
    return codes.select("ts_code").orderBy("ts_code").limit(n)
