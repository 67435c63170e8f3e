"""Trading calendars, and aligning bars to one.

A calendar has one row per day, so it is bounded by the span of the data in days
(some 366 rows a year).  That bound is what allows the broadcast hints and the
un-partitioned window in this module; neither is ever applied to bars."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from barlake.functions.columns import true_only
from barlake.functions.dates import calendar_parts
from barlake.operators.series import by_day, whole_series


def build_calendar(*feeds: DataFrame, first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    """Distinct open days of one or more calendar feeds, optionally limited to years."""
    days = reduce(
        DataFrame.unionByName,
        [f.filter(F.col("is_open") == 1).select(F.col("trade_date").cast("date").alias("trade_date")) for f in feeds],
    )
    if first_year is not None:
        days = days.filter(F.col("trade_date") >= F.make_date(F.lit(first_year), F.lit(1), F.lit(1)))
    if last_year is not None:
        days = days.filter(F.col("trade_date") <= F.make_date(F.lit(last_year), F.lit(12), F.lit(31)))
    return days.distinct()


def previous_open_day(calendar: DataFrame) -> DataFrame:
    """``pretrade_date``: the open day before each open day; NULL on closed days."""
    before = Window.orderBy("trade_date").rowsBetween(Window.unboundedPreceding, -1)
    latest_open = F.last(F.when(F.col("is_open") == 1, F.col("trade_date")), ignorenulls=True).over(before)
    return calendar.withColumn("pretrade_date", F.when(F.col("is_open") == 1, latest_open))


def complete_calendar(open_days: DataFrame, years: DataFrame) -> DataFrame:
    """Every day of each requested year with ``is_open`` and ``pretrade_date``.

    The previous day is looked up within the same year.  A year the feed knows nothing
    about is taken as always open, without previous days, and says so in ``source``."""
    wanted = years.select(F.col("year").cast("int").alias("year")).distinct()
    known = (
        open_days.select(F.col("trade_date").cast("date").alias("trade_date"))
        .distinct()
        .withColumn("opened", F.lit(True))
    )
    days = wanted.select(
        "year",
        F.explode(
            F.sequence(F.make_date("year", F.lit(1), F.lit(1)), F.make_date("year", F.lit(12), F.lit(31)))
        ).alias("trade_date"),
    )
    year_window = Window.partitionBy("year")
    earlier = year_window.orderBy("trade_date").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.max(true_only(F.col("opened"))).over(year_window)
    latest_open = F.last(F.when(F.col("opened"), F.col("trade_date")), ignorenulls=True).over(earlier)
    return (
        days.join(F.broadcast(known), "trade_date", "left")
        .withColumns({"covered": covered, "latest_open": latest_open})
        .select(
            "trade_date",
            F.when(~F.col("covered") | true_only(F.col("opened")), 1).otherwise(0).alias("is_open"),
            F.when(F.col("opened"), F.col("latest_open")).alias("pretrade_date"),
            F.when(F.col("covered"), "feed").otherwise("assumed").alias("source"),
        )
    )


def with_calendar_parts(calendar: DataFrame) -> DataFrame:
    return calendar.withColumns(calendar_parts("trade_date"))


def calendar_align(bars: DataFrame, open_days: DataFrame) -> DataFrame:
    """Put every instrument on the calendar between its first and last bar.

    Missing open days become rows flagged ``flag_aligned`` with zero volume and
    turnover and unknown prices; bars on closed days are dropped; an instrument with no
    open day in its span stays as it was.  A vendor row without a close is flagged too.

    Each bar brings the days up to the next bar of its instrument along, and the days
    that are not open are filtered out again.  So there is one shuffle by instrument,
    which the later windows reuse, and no join between spans and calendar."""
    # bars are few bytes before they are spread: adaptive execution would join too many of them in one task
    bars = bars.repartition(int(bars.sparkSession.conf.get("spark.sql.shuffle.partitions")), "ts_code")
    calendar = open_days.select(F.col("trade_date").alias("cal_day")).distinct().withColumn("cal_open", F.lit(True))
    payload = [c for c in bars.columns if c not in ("ts_code", "trade_date", "flag_aligned")]
    following = F.lead("trade_date").over(by_day())
    last_day = F.coalesce(F.date_sub(following, 1), F.col("trade_date"))
    spread = (
        bars.withColumn("last_day", F.greatest(last_day, F.col("trade_date")))
        .withColumn("cal_day", F.explode(F.sequence("trade_date", "last_day")))
        .join(F.broadcast(calendar), "cal_day", "left")
        .withColumn("own_day", F.col("cal_day") == F.col("trade_date"))
    )
    placed = spread.select(
        "ts_code",
        F.col("cal_day").alias("trade_date"),
        *[F.expr(f"IF(own_day, `{c}`, NULL)").alias(c) for c in payload],
        "own_day",
        true_only(F.col("cal_open")).alias("cal_open"),
    )
    # bool aggregate over the whole series: does the calendar reach this instrument at all?
    reached = placed.withColumn("reached", F.max("cal_open").over(whole_series()))
    kept = reached.filter(F.col("cal_open") | (~F.col("reached") & F.col("own_day")))
    aligned = F.col("reached") & F.col("close").isNull()
    zeroed = {c: F.when(F.col("flag_aligned"), F.lit(0.0)).otherwise(F.col(c)) for c in ("vol", "amount") if c in payload}
    return kept.withColumn("flag_aligned", aligned).withColumns(zeroed).drop("own_day", "cal_open", "reached")
