"""Request windows over several sources, what was known on a day, months found from days, one-pass reports."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from barlake.operators import lookups, quality
from barlake.operators.asof import with_known_report
from barlake.plans.daily import Feeds, Settings, daily_run, outcomes_path
from barlake.plans.incremental import context_months, context_rows
from barlake.schemas import DAILY_BASIC, DAILY_KLINE
from barlake.session import scratch_path
from barlake.sources.routing import fill_windows
from barlake.storage import tables, upserts
from barlake.storage.anchors import anchors_of
from barlake.storage.store import init_store, open_store
from barlake.streaming.ingest import stream_upsert_bars
from tests.test_dataflows import RAW

DAY0 = date(2026, 1, 1)


def day(i: int) -> str:
    return (DAY0 + timedelta(days=i)).isoformat()


def filled(requests: list[tuple], sources: dict[str, set]) -> set:
    """The windows, source by source, by the definition."""
    out, still = set(), list(requests)
    for name, bars in sources.items():
        later = []
        for code, lo, hi in still:
            inside = sorted(x for c, x in bars if c == code and lo <= x <= hi)
            out |= {(code, x, name) for x in inside}
            later += [(code, lo, inside[0] - 1), (code, inside[-1] + 1, hi)] if inside else [(code, lo, hi)]
        still = [w for w in later if w[1] <= w[2]]
    return out


@pytest.mark.parametrize("seed", range(4))
def test_windows_take_what_earlier_sources_lack(frame, seed):
    r = random.Random(seed)
    requests = [(c, lo, hi) for c in "abcd" for lo, hi in ((0, 9), (15, 15), (20, 39)) if r.random() < 0.9]
    sources = {n: {(c, x) for c in "abcde" for x in range(40) if r.random() < share} for n, share in (("one", 0.1), ("two", 0.3), ("three", 0.6))}
    frames = {n: frame("ts_code STRING, trade_date DATE", [(c, day(x)) for c, x in sorted(rows)]) for n, rows in sources.items()}
    asked = frame("ts_code STRING, start_date DATE, end_date DATE", [(c, day(lo), day(hi)) for c, lo, hi in requests])
    got = [(x.ts_code, (x.trade_date - DAY0).days, x.source) for x in fill_windows(asked, frames).collect()]
    assert len(got) == len(set(got)) and set(got) == filled(requests, sources)


@pytest.mark.parametrize("lag", [0, 3])
def test_known_reports(frame, lag):
    r = random.Random(lag)
    reports = {(c, r.randrange(60), r.randrange(8) * 10) for c in "abc" for _ in range(12)}
    reports = {(c, a): e for c, a, e in sorted(reports)}  # one per announcement day
    bars = [(c, x) for c in "abcd" for x in range(0, 70, 3)]
    rows = [(c, day(a), day(e - 200), float(a)) for (c, a), e in reports.items()] + [("a", None, day(5), 99.0), ("a", day(1), None, 98.0)]
    df = frame("ts_code STRING, ann_date DATE, end_date DATE, eps DOUBLE", rows)
    found = with_known_report(frame("ts_code STRING, trade_date DATE, close DOUBLE", [(c, day(x), 1.0) for c, x in bars]), df, lag_days=lag)
    assert found.columns == ["ts_code", "trade_date", "close", "ann_date", "end_date", "eps"]
    got = {(x.ts_code, (x.trade_date - DAY0).days): x.eps for x in found.collect()}
    for c, x in bars:
        known = [(e, a) for (code, a), e in reports.items() if code == c and a + lag <= x]
        assert got[(c, x)] == (float(max(known)[1]) if known else None)
    with pytest.raises(ValueError):
        with_known_report(df.withColumnRenamed("ann_date", "trade_date"), df)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_context_rows_open_only_the_months_of_the_directory(spark, frame):
    path = scratch_path(spark, "kline")
    tables.init_table(spark, path, DAILY_KLINE)
    at = [("a", "2026-01-05"), ("a", "2026-04-20"), ("a", "2026-06-01"), ("a", "2026-06-15"), ("b", "2026-02-10"), ("b", "2026-06-20"), ("c", "2026-06-05")]
    upserts.upsert_bars(spark, path, frame("ts_code STRING, trade_date DATE, close DOUBLE, vol DOUBLE", [(c, x, float(i), 1.0) for i, (c, x) in enumerate(at)]))
    stored = tables.read_table(spark, path, DAILY_KLINE)
    plan = frame("ts_code STRING, start_date DATE", [("a", "2026-06-10"), ("b", "2026-06-10"), ("c", "2026-06-05"), ("new", "2026-06-10")])
    found = anchors_of(stored)
    directory = spark.createDataFrame(found.collect(), found.schema)
    got = context_rows(stored, plan, directory)
    filters = [x for x in plan_of(got).splitlines() if "FileScan" in x]
    assert len(filters) == 1 and "PartitionFilters: [trade_month" in filters[0]
    assert "2026-01" not in filters[0].split("PartitionFilters")[1].split("PushedFilters")[0]
    want = {("a", "2026-06-01", 2.0), ("b", "2026-02-10", 4.0)}
    assert {(x.ts_code, str(x.trade_date), x.close) for x in got.collect()} == want
    assert {(x.ts_code, str(x.trade_date), x.close) for x in context_rows(stored, plan).collect()} == want
    months = {(x.ts_code, x.trade_month) for x in context_months(plan, directory).collect()}
    assert months == {("a", "2026-04"), ("a", "2026-06"), ("b", "2026-02"), ("b", "2026-06"), ("c", "2026-06")}


def test_sql_that_names_a_day_prunes_months_when_it_runs(spark, frame, tmp_path):
    init_store(spark, str(tmp_path))
    many = frame("ts_code STRING, trade_date DATE, close DOUBLE", [("a", f"2026-{m:02d}-10", float(m)) for m in range(1, 7)])
    upserts.upsert_bars(spark, f"{tmp_path}/daily_kline", many)
    tables.upsert(spark, f"{tmp_path}/daily_basic", DAILY_BASIC, many.select("ts_code", "trade_date", F.col("close").alias("pe")))
    store = open_store(spark, str(tmp_path))
    for view in ("daily_kline", "daily_basic", "research_daily_universe"):
        day_rows = lookups.raw_sql(spark, f"SELECT * FROM {view} WHERE trade_date = DATE '2026-03-10'")
        scans = [x for x in plan_of(day_rows).splitlines() if "FileScan" in x and "trade_month" in x]
        assert len(scans) == 1 and "dynamicpruning" in scans[0], scans
        rows = day_rows.collect()
        assert len(rows) == 1 and str(rows[0].trade_date) == "2026-03-10"
    assert spark.table("daily_kline").columns == store["daily_kline"].columns
    assert sorted(r.close for r in spark.table("daily_kline").collect()) == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]


def test_a_store_report_reads_its_bars_once(spark, frame, tmp_path):
    columns = "ts_code STRING, trade_date DATE, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, vol DOUBLE, pct_chg DOUBLE, flag_suspended BOOLEAN, flag_invalid_ohlc BOOLEAN"
    r = random.Random(3)
    maybe = lambda x: None if r.random() < 0.2 else x
    rows = [(f"s{c}", day(x), *[maybe(float(c)) for _ in range(4)], maybe(1.0), maybe(r.uniform(-30, 30)), maybe(r.random() < 0.3), False) for c in range(9) for x in range(6)]
    rows += [("s0", day(-9), 1.0, 1.0, 1.0, 0.0, 1.0, 0.0, False, False), ("s0", day(40), 1.0, 1.0, 1.0, None, 1.0, 0.0, False, False)]
    frame(columns, rows).write.parquet(f"{tmp_path}/bars")
    bars = spark.read.parquet(f"{tmp_path}/bars")
    basics = frame("ts_code STRING, trade_date DATE, pe DOUBLE", [("s1", day(1), 3.0), ("s2", day(1), None)])
    rules = quality.QualityRules(min_stock_count=5, with_basics=True)
    days = frame("trade_date DATE", [(day(x),) for x in (0, 1, 2, 40, 99)])
    for asked in (None, days):
        once = quality.store_report(bars, basics, day(6), rules, asked)
        twice = quality.quality_report(lookups.cross_sections(bars, basics), bars, day(6), rules, asked)
        assert plan_of(once).count("FileScan parquet") == 1
        assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    spans = {x.date_range for x in once.collect() if x.date_range}
    assert [tuple(s) for s in spans] == [(day(-9), day(40))]


def test_a_run_takes_its_windows_from_several_sources(spark, frame):
    root = scratch_path(spark, "store")
    bar = lambda code, x, p: (code, f"2026-06-{x}", p, p, p, p, 5.0, 1.0, 1)
    feeds = Feeds(
        frame("trade_date DATE, is_open INT", [(f"2026-06-{x}", 1) for x in range(12, 18)]),
        frame("ts_code STRING, symbol STRING, name STRING, exchange STRING, list_status STRING", [(c, c[:6], "x", "SZSE", "L") for c in ("000001.SZ", "000002.SZ", "000003.SZ")]),
        {"first": frame(RAW, [bar("000001.SZ", 13, 1.0), bar("000001.SZ", 14, 1.0)]), "second": frame(RAW, [bar(c, x, 2.0) for c in ("000001.SZ", "000002.SZ") for x in range(12, 18)])},
        frame("ts_code STRING, trade_date DATE, adj_factor DOUBLE", []),
    )
    settings = Settings(base_start="2026-06-01", rules=quality.QualityRules(min_stock_count=1))
    daily_run(spark, root, feeds, 1, "2026-06-16", "2026-06-16 18:00:00", "2026-06-16 18:10:00", True, settings)
    got = {(r.ts_code, r.trade_date.day): r.close for r in open_store(spark, root)["daily_kline"].collect()}
    assert got == {**{("000001.SZ", x): 1.0 if x in (13, 14) else 2.0 for x in range(12, 17)}, **{("000002.SZ", x): 2.0 for x in range(12, 17)}}
    outcomes = {r.ts_code: (r.outcome, r.n_rows) for r in spark.read.parquet(outcomes_path(root, 1)).collect()}
    assert outcomes == {"000001.SZ": ("cleaned", 5), "000002.SZ": ("cleaned", 5), "000003.SZ": ("failed", 0)}


def test_a_replayed_stream_puts_no_older_value_back(spark, frame):
    landing, path = scratch_path(spark, "landing"), scratch_path(spark, "streamed")
    schema = frame(RAW, []).schema
    bar = lambda day, p, seq: ("a", day, p, p, p, p, 1.0, 1.0, seq)

    def ingest(checkpoint):
        stream_upsert_bars(spark, landing, schema, path, checkpoint, files_per_batch=1).awaitTermination()
        return {str(r.trade_date): r.close for r in tables.read_table(spark, path, DAILY_KLINE).collect()}

    checkpoint = scratch_path(spark, "checkpoint")
    for rows in ([bar("2026-06-15", 1.0, 1), bar("2026-06-16", 1.0, 2)], [bar("2026-06-16", 5.0, 3), bar("2026-06-17", 5.0, 4)]):
        frame(RAW, rows).coalesce(1).write.mode("append").parquet(landing)
        last = ingest(checkpoint)
    assert last == {"2026-06-15": 1.0, "2026-06-16": 5.0, "2026-06-17": 5.0}
    assert ingest(scratch_path(spark, "lost")) == last
    frame(RAW, [bar("2026-06-15", 7.0, 9)]).coalesce(1).write.mode("append").parquet(landing)
    assert ingest(scratch_path(spark, "lost")) == {**last, "2026-06-15": 7.0}
