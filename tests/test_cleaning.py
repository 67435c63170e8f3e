"""Cleaning: replayed example inputs, edge rows, and a row-by-row reference in pandas."""

from __future__ import annotations

import datetime as dt
import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from barlake.operators import series
from barlake.operators.calendar import calendar_align
from barlake.plans.cleaning import clean_and_adjust, clean_bars
from tests.conftest import by_key


def flat(code, day, price, vol=1000.0, amount=10000.0):
    return (code, day, price, price, price, price, vol, amount)


def test_extreme_move_is_flagged_and_kept(bars):
    days = [str(x.date()) for x in pd.bdate_range("2026-01-01", periods=20)]
    rows = [flat("000001.SZ", day, 10.0) for day in days[:-1]] + [flat("000001.SZ", days[-1], 30.0)]
    last = by_key(clean_bars(bars(rows), order=None))[("000001.SZ", days[-1])]
    assert (last.close, last.flag_extreme, last.flag_invalid_ohlc) == (30.0, True, False)


def test_gap_is_filled_from_the_calendar(bars, frame):
    rows = [
        ("000001.SZ", "2026-06-12", 10.0, 10.5, 9.5, 10.0, 1000.0, 1e4),
        ("000001.SZ", "2026-06-16", 11.0, 11.5, 10.5, 11.0, 1200.0, 1.3e4),
    ]
    days = frame("trade_date DATE", [("2026-06-12",), ("2026-06-15",), ("2026-06-16",), ("2026-06-17",)])
    got = by_key(clean_bars(bars(rows), days, order=None))
    assert len(got) == 3  # nothing after the last bar
    gap = got[("000001.SZ", "2026-06-15")]
    assert (gap.flag_aligned, gap.flag_suspended, gap.vol, gap.amount, gap.pct_chg, gap.log_ret) == (True, True, 0, 0, 0, 0)
    assert (gap.open, gap.high, gap.low, gap.close) == (10.0, 10.5, 9.5, 10.0)
    assert got[("000001.SZ", "2026-06-16")].pct_chg == pytest.approx(10.0)


def test_unknown_amount_stays_unknown(bars):
    row = clean_bars(bars([flat("000001.SZ", "2026-06-15", 10.0, amount=float("nan"))]), order=None).first()
    assert row.amount is None


def test_first_arrival_wins(frame):
    rows = [("a", "2026-01-05", 2.0, 20), ("a", "2026-01-05", 1.0, 10), ("a", "2026-01-05", None, 5), ("b", "2026-01-05", 7.0, 1)]
    out = by_key(series.dedup_first(frame("ts_code STRING, trade_date DATE, close DOUBLE, ingest_seq INT", rows)))
    assert out[("a", "2026-01-05")].close is None and out[("a", "2026-01-05")].ingest_seq == 5
    assert out[("b", "2026-01-05")].close == 7.0


def test_off_calendar_bars_and_unreached_instruments(bars, frame):
    days = frame("trade_date DATE", [("2026-06-15",), ("2026-06-16",)])
    rows = [
        flat("a", "2026-06-13", 1.0),  # Saturday before: dropped, opens the span
        flat("a", "2026-06-16", 2.0),
        flat("b", "2026-06-13", 5.0),  # calendar never reached: stays as it is
        flat("b", "2026-06-14", 0.0, vol=None),
        ("c", "2026-06-15", 1.0, 1.0, 1.0, None, 9.0, 9.0),  # vendor row without close
    ]
    got = by_key(calendar_align(bars(rows), days))
    assert set(got) == {("a", "2026-06-15"), ("a", "2026-06-16"), ("b", "2026-06-13"), ("b", "2026-06-14"), ("c", "2026-06-15")}
    lead = got[("a", "2026-06-15")]
    assert lead.flag_aligned and lead.close is None and lead.vol == 0
    assert not got[("b", "2026-06-13")].flag_aligned and got[("b", "2026-06-14")].vol is None
    assert got[("c", "2026-06-15")].flag_aligned and got[("c", "2026-06-15")].vol == 0


def test_returns_around_zero_and_null(bars):
    closes = [None, 10.0, 0.0, 0.0, 5.0, -5.0, 11.0]
    rows = [("a", f"2026-01-{i + 1:02d}", c, c, c, c, 1.0, 1.0) for i, c in enumerate(closes)]
    got = by_key(clean_bars(bars(rows), order=None))
    at = lambda i: got[("a", f"2026-01-{i + 1:02d}")]
    assert at(0).close is None and at(0).pct_chg is None and not at(0).flag_extreme and not at(0).flag_invalid_ohlc
    assert at(1).pct_chg is None  # nothing known before
    assert at(2).pct_chg == -100.0 and at(2).log_ret is None
    assert at(3).pct_chg is None and at(3).flag_extreme  # extreme because a zero price is invalid
    assert at(4).pct_chg is None and at(4).flag_extreme and not at(4).flag_invalid_ohlc
    assert at(5).pct_chg == -200.0 and at(5).log_ret is None


def test_invalid_ohlc_ignores_unknown_prices(frame):
    rows = [
        (None, None, None, None, False),
        (10.0, None, 9.0, 9.5, False),
        (10.0, 9.0, 9.0, 9.5, True),  # high below open
        (10.0, 11.0, 10.5, 10.2, True),  # low above open
        (10.0, 11.0, -1.0, 10.2, True),
        (None, 0.0, None, None, True),
    ]
    df = frame("open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, want BOOLEAN", rows)
    for r in series.flag_invalid_ohlc(df).collect():
        assert r.flag_invalid_ohlc == r.want and r.flag_extreme == r.want


def test_flags_without_their_columns(frame):
    df = frame("ts_code STRING, trade_date DATE, close DOUBLE", [("a", "2026-01-05", 1.0)])
    assert series.flag_suspended(df).first().flag_suspended is False
    assert "flag_invalid_ohlc" not in series.flag_invalid_ohlc(df).columns
    assert series.flag_listed_codes(df, None).first().is_st is False
    assert series.flag_listed_codes(df, ["a"]).first().is_st is True
    assert series.flag_listed_codes(df, df.select("ts_code")).first().is_st is True


def reference_clean(rows: list[dict], open_days: list[dt.date], limit: float) -> list[tuple]:
    """One instrument at a time, one row at a time."""
    out = []
    for code in sorted({r["ts_code"] for r in rows}):
        mine = {}
        for r in sorted((r for r in rows if r["ts_code"] == code), key=lambda r: r["ingest_seq"]):
            mine.setdefault(r["trade_date"], r)
        span = [day for day in open_days if min(mine) <= day <= max(mine)]
        previous, filled = None, {}
        for day in span or sorted(mine):
            r = mine.get(day, {})
            aligned = bool(span) and r.get("close") is None
            prices = {}
            for p in ("open", "high", "low", "close"):
                filled[p] = prices[p] = r[p] if r.get(p) is not None else filled.get(p)
            vol = 0.0 if aligned else r.get("vol")
            close = prices["close"]
            pct = None
            if aligned:
                pct = 0.0
            elif close is not None and previous:
                pct = (close / previous - 1) * 100
            known = [v for v in (prices["open"], prices["close"], prices["low"]) if v is not None]
            known_high = [v for v in (prices["open"], prices["close"], prices["high"]) if v is not None]
            h, low = prices["high"], prices["low"]
            invalid = (h is not None and bool(known) and h < max(known)) or (low is not None and low > min(known_high or [low]))
            invalid = invalid or any(v is not None and v <= 0 for v in prices.values())
            jump = (pct is not None and abs(pct) > limit) or (pct is None and previous == 0 and close not in (None, 0))
            out.append((code, day, *prices.values(), vol, pct, invalid or jump, not vol, aligned, invalid))
            previous = close
    return out


def test_clean_matches_row_by_row_reference(spark):
    rng = random.Random(7)
    start = dt.date(2026, 1, 1)
    open_days = [start + dt.timedelta(days=i) for i in range(60) if rng.random() < 0.7]
    rows = []
    for code in range(12):
        for i in range(60):
            for copy in range(rng.choice((0, 0, 1, 1, 2))):
                price = lambda: None if rng.random() < 0.1 else round(rng.uniform(-1, 30), 1)
                rows.append(
                    {
                        "ts_code": f"{code:06d}.SZ",
                        "trade_date": start + dt.timedelta(days=i),
                        **{p: price() for p in ("open", "high", "low", "close")},
                        "vol": rng.choice((None, 0.0, 5.0, 5.0)),
                        "ingest_seq": rng.random(),
                    }
                )
    df = spark.createDataFrame(rows, "ts_code STRING, trade_date DATE, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, vol DOUBLE, ingest_seq DOUBLE")
    days = spark.createDataFrame([(x,) for x in open_days], "trade_date DATE")
    got = clean_bars(df.repartition(3), days, 40.0).select(
        "ts_code", "trade_date", "open", "high", "low", "close", "vol", "pct_chg",
        "flag_extreme", "flag_suspended", "flag_aligned", "flag_invalid_ohlc",
    )
    assert sorted(map(tuple, got.collect()), key=str) == sorted(reference_clean(rows, open_days, 40.0), key=str)


def test_factor_fills_and_anchors(bars, frame):
    rows = [flat("a", f"2026-06-{x}", p) for x, p in ((15, 10.0), (16, 11.0), (17, 12.0), (18, 13.0))] + [flat("b", "2026-06-15", 7.0)]
    factors = frame(
        "ts_code STRING, trade_date DATE, adj_factor DOUBLE",
        [("a", "2026-06-16", 1.0), ("a", "2026-06-18", 2.0), ("a", "2026-06-20", 9.0)],  # the last is on no bar's day
    )
    got = by_key(clean_and_adjust(bars(rows), factors, order=None))
    a = [got[("a", f"2026-06-{x}")] for x in (15, 16, 17, 18)]
    assert [r.adj_factor for r in a] == [1.0, 1.0, 1.0, 2.0]
    assert [r.adj_close_qfq for r in a] == [5.0, 5.5, 6.0, 13.0]
    assert got[("b", "2026-06-15")].adj_close_qfq is None
    assert all(math.isclose(r.adj_close_qfq, r.close) for r in a[-1:])


def test_log_return_matches(bars):
    rows = [flat("a", "2026-06-15", 10.0), flat("a", "2026-06-16", 12.0)]
    got = by_key(series.returns(bars(rows)))
    assert got[("a", "2026-06-16")].log_ret == pytest.approx(math.log(1.2))
    assert got[("a", "2026-06-15")].log_ret is None


def test_fill_both_ways(frame):
    df = frame("ts_code STRING, trade_date DATE, x DOUBLE", [("a", "2026-01-01", None), ("a", "2026-01-02", 3.0), ("a", "2026-01-03", None), ("b", "2026-01-01", None)])
    got = by_key(series.fill_both_ways(df, ["x"]))
    assert [got[("a", f"2026-01-0{i}")].x for i in (1, 2, 3)] == [3.0, 3.0, 3.0]
    assert got[("b", "2026-01-01")].x is None
    assert series.forward_fill(df.withColumnRenamed("x", "close")).filter(F.col("close").isNull()).count() == 2
