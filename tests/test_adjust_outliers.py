from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from barlake.operators.adjust import adjust_prices
from barlake.operators.outliers import flag_outliers, winsorize
from tests.conftest import by_key

FACTOR = "ts_code STRING, trade_date DATE, adj_factor DOUBLE"


@pytest.fixture
def two_bars(bars):
    return bars([("a", "2026-06-15", 10.0, 10.0, 10.0, 10.0, 1.0, 1.0), ("a", "2026-06-16", 11.0, 11.0, 11.0, 11.0, 1.0, 1.0)])


@pytest.mark.parametrize(("method", "want"), [("qfq", [5.0, 11.0]), ("hfq", [10.0, 22.0]), ("other", [10.0, 22.0]), ("none", [10.0, 11.0])])
def test_methods(two_bars, frame, method, want):
    factors = frame(FACTOR, [("a", "2026-06-15", 1.0), ("a", "2026-06-16", 2.0)])
    got = by_key(adjust_prices(two_bars, factors, method))
    assert [got[("a", f"2026-06-{x}")].adj_close for x in (15, 16)] == want


def test_no_factors(two_bars, frame):
    for factors in (None, frame(FACTOR, [])):
        assert {r.adj_close for r in adjust_prices(two_bars, factors, "qfq").collect()} == {None}
    zero = frame(FACTOR, [("a", "2026-06-15", 0.0)])
    assert {r.adj_close for r in adjust_prices(two_bars, zero, "qfq").collect()} == {None}


def test_none_keeps_a_factor(two_bars):
    from pyspark.sql import functions as F

    kept = adjust_prices(two_bars.withColumn("adj_factor", F.lit(3.0)), None, "none")
    assert {r.adj_factor for r in kept.collect()} == {3.0}
    assert {r.adj_factor for r in adjust_prices(two_bars, None, "none").collect()} == {None}


def brute(values: pd.Series, method: str, k: float) -> tuple[pd.Series, pd.Series]:
    """Outlier marks and winsorised values of one series."""
    x = values.dropna()
    if method == "zscore":
        centre, spread = x.mean(), x.std()
        low, high = centre - k * spread, centre + k * spread
        far = (x - centre).abs() / spread > k if spread else x.astype(bool) & False
    elif method == "iqr":
        q1, q3 = x.quantile(0.25), x.quantile(0.75)
        spread = q3 - q1
        low, high = q1 - k * spread, q3 + k * spread
        far = (x < low) | (x > high)
    else:
        centre = x.median()
        spread = (x - centre).abs().median()
        low, high = centre - k * spread, centre + k * spread
        far = (x - centre).abs() / spread > k if spread else x.astype(bool) & False
    usable = len(x) >= 10 and spread not in (0, None) and not np.isnan(spread)
    marks = pd.Series(False, index=values.index)
    if usable:
        marks[far[far].index] = True
    pulled = values if spread == 0 or np.isnan(spread) else values.clip(low, high)
    return marks, pulled


@pytest.mark.parametrize(("method", "limit"), [("mad", 5.0), ("zscore", 3.0), ("iqr", 1.5), ("mad", 2.0)])
def test_against_pandas(spark, method, limit):
    rng = np.random.default_rng(3)
    pieces = {
        "long": rng.normal(100, 5, 200).round(2),
        "heavy": rng.standard_cauchy(150).round(3),
        "short": np.array([1.0, 2, 3, 4, 5, 6, 7, 8, 1000]),
        "flat": np.full(20, 7.0),
        "mostly": np.array([5.0] * 15 + [6.0, 900.0]),
        "one": np.array([4.0]),
        "holes": np.where(np.arange(30) % 4 == 0, np.nan, rng.normal(0, 1, 30)),
        "none": np.array([np.nan] * 12),
    }
    rows = [(code, i, None if np.isnan(v) else float(v)) for code, vs in pieces.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "ts_code STRING, i INT, x DOUBLE")
    out = winsorize(flag_outliers(df, "x", method, limit), "x", method, limit, name="y").toPandas()
    for code, part in out.groupby("ts_code"):
        part = part.sort_values("i").reset_index(drop=True)
        marks, pulled = brute(part["x"], method, limit)
        assert part["is_outlier"].tolist() == marks.tolist(), code
        np.testing.assert_allclose(part["y"].to_numpy(float), pulled.to_numpy(float), rtol=1e-12)


def test_unknown_method_marks_by_mad_and_pulls_nothing(spark):
    rows = [("a", float(i)) for i in range(12)] + [("a", 500.0)]
    df = spark.createDataFrame(rows, "ts_code STRING, x DOUBLE")
    assert flag_outliers(df, "x", "guess").filter("is_outlier").count() == 1
    assert winsorize(df, "x", "guess").filter("x = 500").count() == 1
