from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from barlake.operators import universe
from tests.conftest import by_key

META = "ts_code STRING, symbol STRING, name STRING, exchange STRING, area STRING, industry STRING, list_status STRING, list_date DATE, delist_date DATE"
KLINE = "ts_code STRING, trade_date DATE, close DOUBLE, flag_extreme BOOLEAN, flag_suspended BOOLEAN, flag_aligned BOOLEAN, flag_invalid_ohlc BOOLEAN"
HISTORY = "ts_code STRING, name STRING, start_date DATE, end_date DATE, is_st BOOLEAN"


def meta(code, listed="2020-01-01", gone=None, name="plain"):
    return (code, code[:6], name, "SZSE", "x", "y", "D" if gone else "L", listed, gone)


def bar(code, close=10.0, extreme=False, suspended=False, aligned=False, invalid=False, day="2026-06-16"):
    return (code, day, close, extreme, suspended, aligned, invalid)


def test_every_reason(frame):
    bars = frame(
        KLINE,
        [
            bar("000001.SZ"), bar("000002.SZ", suspended=True), bar("000003.SZ"), bar("000004.SZ", invalid=True, extreme=True),
            bar("000005.SZ"), bar("000006.SZ"), bar("000007.SZ"), bar("000008.SZ", aligned=True), bar("000009.SZ", extreme=True),
            bar("000010.SZ", close=None), bar("000011.SZ", close=0.0), bar("000012.SZ", extreme=None), bar("000013.SZ", close=None, extreme=True),
        ],
    )
    codes = [c for c in (f"{i:06d}.SZ" for i in range(1, 14)) if c not in ("000003.SZ", "000006.SZ", "000007.SZ")]
    listed = [meta(c) for c in codes] + [meta("000003.SZ", gone="2026-06-15"), meta("000007.SZ", listed="2026-06-17")]
    history = frame(HISTORY, [("000001.SZ", "*ST", "2026-01-01", "2026-12-31", True)])
    full = universe.research_universe(bars, frame(META, listed), history)
    got = {k[0]: (r.exclude_reason, r.is_in_universe) for k, r in by_key(full).items()}
    assert got == {
        "000001.SZ": ("historical_st", False),
        "000002.SZ": ("suspended", False),
        "000003.SZ": ("delisted", False),
        "000004.SZ": ("invalid_ohlc", False),
        "000005.SZ": (None, True),
        "000006.SZ": ("missing_stock_meta", True),  # metadata alone does not exclude
        "000007.SZ": ("pre_list", False),
        "000008.SZ": ("calendar_aligned", False),
        "000009.SZ": ("extreme", False),
        "000010.SZ": ("invalid_close", None),  # unknown stays unknown
        "000011.SZ": ("invalid_close", False),
        "000012.SZ": (None, True),
        "000013.SZ": ("extreme", False),
    }
    investable = universe.universe_on(full, "2026-06-16")
    assert [r.ts_code for r in investable.collect()] == ["000005.SZ", "000006.SZ", "000012.SZ"]
    assert universe.universe_on(full, "2026-06-16", only_in_universe=False).count() == 13
    assert universe.universe_on(full, "2026-06-17", only_in_universe=False).count() == 0


def test_listing_bounds(frame):
    days = ["2026-06-14", "2026-06-15", "2026-06-16", "2026-06-17"]
    bars = frame(KLINE, [bar("a", day=x) for x in days])
    full = universe.research_universe(bars, frame(META, [meta("a", "2026-06-15", "2026-06-17")]), frame(HISTORY, []))
    assert [r.is_listed_on_date for r in full.orderBy("trade_date").collect()] == [False, True, True, False]


@pytest.mark.parametrize("seed", range(3))
def test_intervals_against_brute_force(frame, seed):
    rng = random.Random(seed)
    day = lambda i: f"2026-03-{i:02d}"
    history = []
    for code in "abc":
        for n in range(rng.choice((0, 3, 25))):
            start = rng.randint(1, 28)
            end = rng.choice((None, start - 1, start, start + rng.randint(0, 5)))
            history.append((code, f"n{n}", day(start), day(end) if end and end > 0 else None, rng.choice((True, False, None))))
    bars = [(code, day(i), 1.0, False, False, False, False) for code in "abcd" for i in range(1, 31)]
    bars_df, hist_df = frame(KLINE, bars), frame(HISTORY, history)
    marked = by_key(universe.with_st_on_date(bars_df, hist_df))
    counted = by_key(universe.count_covering_intervals(bars_df, hist_df))
    assert len(marked) == len(counted) == len(bars)
    for code, at, *_ in bars:
        cover = [h for h in history if h[0] == code and h[2] <= at and (h[3] is None or at <= h[3])]
        assert counted[(code, at)].n_intervals == len(cover)
        assert counted[(code, at)].n_st_intervals == sum(h[4] is True for h in cover)
        assert marked[(code, at)].is_st_on_date == any(h[4] is True for h in cover)


def test_merged_periods_are_disjoint(frame):
    rows = [
        ("a", "1", "2026-01-01", "2026-01-05", True), ("a", "2", "2026-01-03", "2026-01-04", True),
        ("a", "3", "2026-01-06", "2026-01-07", True), ("a", "4", "2026-01-09", None, True),
        ("a", "5", "2026-02-09", "2026-02-10", True), ("a", "6", "2026-01-01", None, False),
    ]
    got = [(str(r.st_from), str(r.st_to)) for r in universe.merged_st_intervals(frame(HISTORY, rows)).orderBy("st_from").collect()]
    assert got == [("2026-01-01", "2026-01-07"), ("2026-01-09", "9999-12-31")]


def test_pool(frame):
    stocks = frame(
        META,
        [
            meta("000001.SZ", None), meta("000002.SZ", None, name="*St x"), meta("600000.SH", None), meta("920000.BJ", None),
            meta("000003.SZ", gone="2026-01-01"), meta("000004.SZ", "2026-06-01"), meta("000005.SZ", "2026-04-17"),
        ],
    )
    pool = lambda **kw: [r[0] for r in universe.stock_pool(stocks, "2026-06-16", **kw).orderBy("ts_code").collect()]
    assert pool(include_exchanges=["SZSE", "SSE"]) == ["000001.SZ", "000005.SZ", "600000.SH"]
    assert pool(include_exchanges=["nowhere"]) == []
    assert "920000.BJ" in pool()
    assert "000002.SZ" in pool(exclude_st=False)
    assert "000004.SZ" in pool(exclude_ipo_within_days=0)
    assert pool(include_exchanges=["SZSE"], head=1) == ["000001.SZ"]


def test_day_filter_reaches_both_scans(spark, frame, tmp_path):
    bars = frame(KLINE, [bar("a", day=f"2026-06-{x}") for x in (15, 16, 17)])
    bars.write.parquet(f"{tmp_path}/bars")
    stored = spark.read.parquet(f"{tmp_path}/bars")
    full = universe.research_universe(stored, frame(META, [meta("a")]), frame(HISTORY, []))
    plan = universe.universe_on(full, "2026-06-16")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("EqualTo(trade_date" in line for line in scans)
    assert F.col is not None
