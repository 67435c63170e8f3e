"""Outlier marks and winsorising within one instrument's series.

Medians and quartiles are exact.  The group is an instrument's series, so it has at
most one value per day; the values of all instruments together never meet in a task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from barlake.functions.columns import col_of, true_only

DEFAULT_LIMIT = {"mad": 5.0, "zscore": 3.0, "iqr": 1.5}
MIN_VALUES = 10


def _series() -> WindowSpec:
    return Window.partitionBy("ts_code")


def _with_centre_and_spread(df: DataFrame, value: Column, method: str) -> DataFrame:
    """Columns ``low_ref``, ``high_ref`` and ``spread``: the band is
    [low_ref - k * spread, high_ref + k * spread]."""
    if method == "zscore":
        stats = {"low_ref": F.avg(value).over(_series()), "spread": F.stddev_samp(value).over(_series())}
        return df.withColumns(stats).withColumn("high_ref", F.col("low_ref"))
    if method == "iqr":
        quartiles = F.percentile(value, F.array(F.lit(0.25), F.lit(0.75))).over(_series())
        return (
            df.withColumn("quartiles", quartiles)
            .withColumns({"low_ref": F.get("quartiles", F.lit(0)), "high_ref": F.get("quartiles", F.lit(1))})
            .withColumn("spread", F.col("high_ref") - F.col("low_ref"))
            .drop("quartiles")
        )
    centred = df.withColumn("low_ref", F.median(value).over(_series()))
    deviation = F.abs(value - F.col("low_ref"))
    return centred.withColumns({"spread": F.median(deviation).over(_series()), "high_ref": F.col("low_ref")})


def flag_outliers(
    df: DataFrame,
    column: str,
    method: str = "mad",
    limit: float | None = None,
    name: str = "is_outlier",
) -> DataFrame:
    """Mark values far from the rest of their series.

    Series with fewer than ten known values, or without spread, have no outliers.
    Methods: ``mad`` (also for unknown names), ``zscore``, ``iqr``."""
    method = method if method in DEFAULT_LIMIT else "mad"
    k = DEFAULT_LIMIT[method] if limit is None else limit
    value = col_of(column)
    measured = _with_centre_and_spread(df, value, method).withColumn("known", F.count(value).over(_series()))
    if method == "iqr":
        far = (value < F.col("low_ref") - F.col("spread") * k) | (value > F.col("high_ref") + F.col("spread") * k)
    else:
        far = F.abs(value - F.col("low_ref")) / F.nullif(F.col("spread"), F.lit(0.0)) > k
    usable = (F.col("known") >= MIN_VALUES) & (F.col("spread") != 0)
    return measured.withColumn(name, true_only(usable & far)).drop("low_ref", "high_ref", "spread", "known")


def winsorize(
    df: DataFrame,
    column: str,
    method: str = "mad",
    limit: float | None = None,
    name: str | None = None,
) -> DataFrame:
    """Pull values outside the band to its edge.  No spread, or an unknown method: no change."""
    target = name or column
    if method not in DEFAULT_LIMIT:
        return df.withColumn(target, F.col(column))
    k = DEFAULT_LIMIT[method] if limit is None else limit
    value = col_of(column)
    low = F.col("low_ref") - F.col("spread") * k
    high = F.col("high_ref") + F.col("spread") * k
    pulled = (
        F.when(true_only(F.col("spread") == 0) | F.col("spread").isNull(), value)
        .when(value < low, low)
        .when(value > high, high)
        .otherwise(value)
    )
    return _with_centre_and_spread(df, value, method).withColumn(target, pulled).drop("low_ref", "high_ref", "spread")
