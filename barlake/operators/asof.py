"""What was known on a day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from barlake.schemas import FINANCIAL_INDICATORS

REPORT_COLUMNS = tuple(c for c in FINANCIAL_INDICATORS.columns if c not in ("ts_code", "ann_date", "end_date"))


def with_known_report(bars: DataFrame, reports: DataFrame, columns: tuple[str, ...] = REPORT_COLUMNS, lag_days: int = 0) -> DataFrame:
    """Bars with the report of their instrument that was the newest one announced by that day.

    A report counts from its ``ann_date`` on, or ``lag_days`` later.  The newest one is that of the latest ``end_date``; if that
    quarter was announced again, the last announcement counts.  A restated older quarter does not
    replace a newer one.  Adds ``ann_date``, ``end_date`` and ``columns``, NULL before the first report.

    Announcements and bars of an instrument are laid into one order of days and the greatest report so far
    is carried along: no range join, and no more rows than there are bars and reports."""
    have = [c for c in columns if c in reports.columns]
    taken = {"ann_date", "end_date", *have} & set(bars.columns)
    if taken:
        raise ValueError(f"bars already have {sorted(taken)}")
    report = F.struct("end_date", "ann_date", *have)
    announced = reports.filter("ann_date is not null and end_date is not null").select(
        "ts_code", F.date_add("ann_date", lag_days).alias("on_day"), F.lit(0).alias("is_bar"), report.alias("report")
    )
    days = bars.select("ts_code", F.col("trade_date").alias("on_day"), F.lit(1).alias("is_bar"), F.struct(*bars.columns).alias("bar"))
    so_far = Window.partitionBy("ts_code").orderBy("on_day", "is_bar").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = days.unionByName(announced, allowMissingColumns=True).withColumn("known", F.max("report").over(so_far))
    return known.filter("is_bar = 1").select("bar.*", F.col("known.ann_date"), F.col("known.end_date"), *[F.col(f"known.{c}") for c in have])
