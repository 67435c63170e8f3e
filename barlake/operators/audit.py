"""Comparing the closes of two sources, instrument by instrument."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from barlake.functions.columns import ratio, true_only
from barlake.operators.lookups import between_days
from barlake.schemas import BAR_KEY


def _paired(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """Both sources side by side.  Keys are unique per source, so nothing multiplies and a
    busy instrument spreads over its days."""
    left = primary.select(*BAR_KEY, F.col("close").alias("close_primary"), F.lit(True).alias("in_primary"))
    right = secondary.select(*BAR_KEY, F.col("close").alias("close_secondary"), F.lit(True).alias("in_secondary"))
    return left.join(right, list(BAR_KEY), "full_outer")


def _difference_pct() -> Column:
    """Absolute difference in percent of the primary close; unknown for a zero close."""
    gap = F.abs(F.col("close_primary") - F.col("close_secondary"))
    return ratio(gap, F.abs("close_primary")) * 100


def compare_sources(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """Days both sources have, with both closes and their difference in percent."""
    both = _paired(primary, secondary).filter("in_primary and in_secondary")
    return both.select(*BAR_KEY, "close_primary", "close_secondary", _difference_pct().alias("close_diff_pct"))


def audit_sources(
    codes: DataFrame,
    primary: DataFrame,
    secondary: DataFrame,
    start: str,
    end: str,
    audit_date: str,
    tolerance_pct: float = 1.0,
    primary_name: str = "tencent",
    secondary_name: str = "sina",
) -> DataFrame:
    """One audit row per requested instrument, in the shape of the audit table; other instruments'
    rows leave before the two sources are joined.

    ``failed`` if a source has no rows in the range or the two share no day; ``warning``
    if the largest difference exceeds the tolerance; otherwise ``normal`` (also if all
    differences are unknown)."""
    both = F.col("in_primary") & F.col("in_secondary")
    asked = codes.select("ts_code").distinct()
    wanted = [between_days(source, start, end).join(asked, "ts_code", "left_semi") for source in (primary, secondary)]
    measured = (
        _paired(*wanted)
        .groupBy("ts_code")
        .agg(
            F.count("in_primary").alias("n_primary"),
            F.count("in_secondary").alias("n_secondary"),
            F.count_if(true_only(both)).alias("n_both"),
            F.max(F.when(both, _difference_pct())).alias("max_diff"),
        )
    )
    empty = true_only((F.col("n_primary") > 0) & (F.col("n_secondary") > 0)) == F.lit(False)
    message = F.when(empty, "source returned empty data").when(F.col("n_both") == 0, "no overlapping trade dates")
    status = (
        F.when(F.col("error_msg").isNotNull(), "failed")
        .when(F.col("max_diff") > tolerance_pct, "warning")
        .otherwise("normal")
    )
    return (
        codes.select("ts_code")
        .join(measured, "ts_code", "left")
        .withColumn("error_msg", message)
        .select(
            F.lit(audit_date).cast("date").alias("audit_date"),
            "ts_code",
            F.lit(start).cast("date").alias("start_date"),
            F.lit(end).cast("date").alias("end_date"),
            F.lit(primary_name).alias("primary_source"),
            F.lit(secondary_name).alias("secondary_source"),
            F.when(F.col("error_msg").isNull(), F.col("n_both")).otherwise(0).cast("int").alias("compared_rows"),
            F.when(F.col("error_msg").isNull(), F.round("max_diff", 6)).alias("max_close_diff_pct"),
            status.alias("status"),
            "error_msg",
        )
    )
