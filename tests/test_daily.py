"""A store from the first full refresh to the next day's run, and its SQL views."""

from __future__ import annotations

import json
from pathlib import Path

import pytest

from barlake.operators.lookups import raw_sql
from barlake.operators.quality import QualityRules
from barlake.plans.daily import Feeds, Settings, daily_run
from barlake.session import scratch_path
from barlake.storage.store import open_store
from tests.test_dataflows import RAW


@pytest.fixture(scope="module")
def store(spark):
    from datetime import date

    day = date.fromisoformat
    make = spark.createDataFrame
    root = scratch_path(spark, "store")
    bar = lambda code, x, p, vol=5.0: (code, day(f"2026-06-{x}"), p, p, p, p, vol, 1.0, 1)
    bars = [bar("000001.SZ", 12, 10.0), bar("000001.SZ", 15, 11.0), bar("000001.SZ", 16, 11.5), bar("600000.SH", 12, 7.0), bar("600000.SH", 16, 7.1), bar("600000.SH", 17, 7.2)]
    instruments = [("000001.SZ", "000001", "x", "SZSE", "L"), ("600000.SH", "600000", "y", "SSE", "L"), ("600001.SH", "600001", "no bars", "SSE", "L"), ("000002.SZ", "000002", "*ST z", "SZSE", "L")]
    history = [("600000.SH", "*ST y", day("2026-06-16"), day("2026-06-16"), "ST", True)]
    calendar = [(day(f"2026-06-{x}"), 0 if x in (13, 14) else 1) for x in range(12, 18)]
    factors = [("000001.SZ", day("2026-06-12"), 1.0), ("000001.SZ", day("2026-06-17"), 2.0)]
    feed = Feeds(
        make(calendar, "trade_date DATE, is_open INT"),
        make(instruments, "ts_code STRING, symbol STRING, name STRING, exchange STRING, list_status STRING"),
        make(bars, RAW),
        make(factors, "ts_code STRING, trade_date DATE, adj_factor DOUBLE"),
        name_history=make(history, "ts_code STRING, name STRING, start_date DATE, end_date DATE, change_reason STRING, is_st BOOLEAN"),
        second_source=make([(b[0], b[1], b[5]) for b in bars], "ts_code STRING, trade_date DATE, close DOUBLE"),
    )
    settings = Settings(rules=QualityRules(min_stock_count=1))
    first = daily_run(spark, root, feed, 1, "2026-06-16", "2026-06-16 18:00:00", "2026-06-16 18:10:00", full_refresh=True, settings=settings)
    second = daily_run(spark, root, feed, 2, "2026-06-17", "2026-06-17 18:00:00", "2026-06-17 18:01:00", settings=settings)
    return root, open_store(spark, root), (first, second)


def test_statuses_and_log(store):
    _, frames, statuses = store
    assert statuses == ("partial", "partial")  # one instrument of the pool has no bars
    log = {r.id: r for r in frames["pipeline_log"].collect()}
    assert (log[1].duration_sec, log[1].stocks_cleaned, log[2].stocks_cleaned) == (600.0, 2, 2)
    assert log[1].error_msg == "600001.SH: 数据源返回空数据"
    assert json.loads(log[1].quality_report)["stock_count"] == 2


def test_a_broken_run_is_logged(spark, store):
    root = scratch_path(spark, "broken")
    bars = spark.createDataFrame([], RAW)
    feed = Feeds(spark.createDataFrame([], "trade_date DATE"), bars, bars, bars)  # calendar without open marks
    with pytest.raises(Exception):
        daily_run(spark, root, feed, 7, "2026-06-16", "2026-06-16 18:00:00")
    row = open_store(spark, root)["pipeline_log"].first()
    assert (row.id, row.status) == (7, "failed") and row.error_msg and row.end_time


def test_tables(store):
    _, frames, _ = store
    bars = {(r.ts_code, str(r.trade_date)): r for r in frames["daily_kline"].collect()}
    assert len(bars) == 3 + 4  # each instrument from its first to its last bar, on open days
    assert bars[("600000.SH", "2026-06-15")].flag_aligned
    assert ("000001.SZ", "2026-06-17") not in bars  # nothing after the last bar
    assert bars[("000001.SZ", "2026-06-16")].adj_close_qfq == 11.5
    calendar = {str(r.trade_date): r for r in frames["trade_calendar"].collect()}
    assert str(calendar["2026-06-15"].pretrade_date) == "2026-06-12" and calendar["2026-06-14"].pretrade_date is None
    audits = {(r.ts_code, r.status) for r in frames["data_source_audit"].collect()}
    assert audits == {("000001.SZ", "normal"), ("600000.SH", "normal"), ("600001.SH", "failed")}


def test_sql_views(spark, store):
    root, _, _ = store
    open_store(spark, root)  # the views are the session's: make sure they show this store
    got = raw_sql(
        spark,
        "SELECT ts_code, exclude_reason FROM research_daily_universe WHERE trade_date = CAST(? AS DATE) ORDER BY ts_code",
        ["2026-06-16"],
    )
    assert [tuple(r) for r in got.collect()] == [("000001.SZ", None), ("600000.SH", "historical_st")]
    assert sorted(p.name for p in Path(root, "quality_reports").glob("report_date=*")) == ["report_date=2026-06-16", "report_date=2026-06-17"]
