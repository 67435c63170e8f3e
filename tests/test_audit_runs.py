from __future__ import annotations

import datetime as dt

from barlake.operators import audit, lookups, runs
from barlake.plans.audit import sampled_source_audit

CLOSE = "ts_code STRING, trade_date DATE, close DOUBLE"
AUDIT = dict(start="2026-06-10", end="2026-06-16", audit_date="2026-06-17")


def test_statuses(frame):
    primary = frame(CLOSE, [("a", "2026-06-15", 10.0), ("a", "2026-06-16", 11.0), ("b", "2026-06-15", 10.0), ("c", "2026-06-15", 10.0),
                            ("d", "2026-06-15", 0.0), ("e", "2026-06-01", 9.0), ("f", "2026-06-15", None)])
    secondary = frame(CLOSE, [("a", "2026-06-15", 10.0), ("a", "2026-06-16", 11.22), ("b", "2026-06-15", 10.1), ("c", "2026-06-16", 10.0),
                              ("d", "2026-06-15", 5.0), ("e", "2026-06-15", 9.0), ("f", "2026-06-15", 1.0)])
    codes = frame("ts_code STRING", [(c,) for c in "abcdefg"])
    got = {r.ts_code: (r.compared_rows, r.max_close_diff_pct, r.status, r.error_msg) for r in audit.audit_sources(codes, primary, secondary, **AUDIT).collect()}
    empty, apart = "source returned empty data", "no overlapping trade dates"
    assert got == {
        "a": (2, 2.0, "warning", None),
        "b": (1, 1.0, "normal", None),
        "c": (0, None, "failed", apart),
        "d": (1, None, "normal", None),
        "e": (0, None, "failed", empty),
        "f": (1, None, "normal", None),
        "g": (0, None, "failed", empty),
    }
    assert audit.compare_sources(primary, secondary).count() == 5


def test_sample_takes_the_first_codes(frame):
    rows = frame(CLOSE, [(c, "2026-06-12", 1.0) for c in "cab"])
    got = sampled_source_audit(frame("ts_code STRING", [("c",), ("a",), ("b",)]), rows, rows, "2026-06-16", "2026-06-17", sample_size=2)
    assert {(r.ts_code, str(r.start_date), r.status) for r in got.collect()} == {("a", "2026-06-11", "normal"), ("b", "2026-06-11", "normal")}


def test_run_log(spark):
    at = lambda h, m=0: dt.datetime(2026, 6, 16, h, m)
    start = [(1, dt.date(2026, 6, 16), at(1), None, None, None, None, None, None), (2, dt.date(2026, 6, 17), at(2), None, None, None, None, None, None)]
    end = [(1, None, None, at(1, 2), "failed", 5, 4, "x", "{}"), (1, None, None, at(1, 3), "success", 6, 6, None, "{}")]
    schema = (
        "id INT, run_date DATE, start_time TIMESTAMP, end_time TIMESTAMP, status STRING, stocks_fetched INT, "
        "stocks_cleaned INT, error_msg STRING, quality_report STRING"
    )
    log = runs.fold_run_log(spark.createDataFrame(start + end, schema))
    got = {r.id: r for r in log.collect()}
    assert (got[1].status, got[1].stocks_fetched, got[1].duration_sec, got[1].error_msg) == ("success", 6, 180.0, None)
    assert (got[2].status, got[2].stocks_fetched, got[2].duration_sec, got[2].end_time) == ("running", 0, None, None)
    assert [r.id for r in lookups.recent_runs(log, 1).collect()] == [2]
    due = runs.days_since_success(log, "2026-06-22").first()
    assert (due.days_since, due.maintenance_due) == (6, False)
    never = runs.days_since_success(log.filter("id = 2"), "2026-06-22").first()
    assert (never.days_since, never.maintenance_due) == (None, True)


def test_run_status(spark):
    rows = [("r1", "a", "failed", 0), ("r2", "a", "failed", 0), ("r2", "b", "up_to_date", 0), ("r3", "a", "cleaned", 7), ("r3", "b", "cleaned", 3), ("r4", "a", "up_to_date", 0)]
    tallies = runs.run_tallies(spark.createDataFrame(rows, "run STRING, ts_code STRING, outcome STRING, n_rows INT"), "run")
    got = {r.run: (r.status, r.kline_rows) for r in tallies.withColumn("status", runs.run_status()).collect()}
    assert got == {"r1": ("failed", 0), "r2": ("partial", 0), "r3": ("success", 10), "r4": ("success", 0)}
    from pyspark.sql import functions as F

    critical = tallies.select("run", runs.run_status(F.lit("critical")).alias("status"))
    assert {r.run: r.status for r in critical.collect()} == {"r1": "failed", "r2": "partial", "r3": "partial", "r4": "partial"}
