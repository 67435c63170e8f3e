from __future__ import annotations

import datetime as dt

from barlake.operators.calendar import calendar_align
from barlake.operators import calendar, lookups


def day(text):
    return dt.date.fromisoformat(text)


def test_build_calendar_keeps_open_days_of_all_years(frame):
    feeds = [frame("trade_date DATE, is_open INT", [(f"{y}-01-05", 1), (f"{y}-01-06", 0), (f"{y}-01-05", 1)]) for y in range(2019, 2028)]
    got = sorted(r[0] for r in calendar.build_calendar(*feeds, first_year=2020, last_year=2026).collect())
    assert got == [dt.date(y, 1, 5) for y in range(2020, 2027)]


def test_completion(frame):
    feed = frame("trade_date DATE", [("2025-12-30",), ("2025-12-31",), ("2026-01-02",)])
    years = frame("year INT", [(2025,), (2026,), (2024,)])
    got = {r.trade_date: r for r in calendar.complete_calendar(feed, years).collect()}
    assert len(got) == 366 + 365 + 365
    assert (got[day("2025-12-31")].is_open, got[day("2025-12-31")].pretrade_date) == (1, day("2025-12-30"))
    assert got[day("2026-01-02")].pretrade_date is None  # looked up within the year
    assert (got[day("2026-01-03")].is_open, got[day("2026-01-03")].pretrade_date) == (0, None)
    assert {(r.is_open, r.source, r.pretrade_date) for r in got.values() if r.trade_date.year == 2024} == {(1, "assumed", None)}


def test_previous_open_day_spans_years(frame):
    cal = frame("trade_date DATE, is_open INT", [("2025-12-31", 1), ("2026-01-01", 0), ("2026-01-02", 1)])
    got = {str(r.trade_date): r.pretrade_date for r in calendar.previous_open_day(cal).collect()}
    assert got == {"2025-12-31": None, "2026-01-01": None, "2026-01-02": day("2025-12-31")}


def test_recent_days(frame):
    cal = frame("trade_date DATE, is_open INT", [(f"2026-01-{x:02d}", x % 2) for x in range(1, 21)])
    got = [r[0].day for r in lookups.recent_trade_dates(cal, "2026-01-16", 3).collect()]
    assert got == [15, 13, 11]


def test_spread_bars_are_not_joined_in_few_tasks(frame, spark):
    rows = [(f"c{i}", day, 1.0) for i in range(40) for day in ("2024-01-02", "2024-06-03")]
    bars = frame("ts_code STRING, trade_date DATE, close DOUBLE", rows)
    days = frame("trade_date DATE", [("2024-01-02",), ("2024-03-05",), ("2024-06-03",)])
    found = calendar_align(bars, days)
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert found.count() == 120
