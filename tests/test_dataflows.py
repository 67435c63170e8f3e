"""Incremental runs, the stream, plan shapes, and the driver contract."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from barlake.plans.cleaning import clean_and_adjust, clean_bars
from barlake.plans.incremental import incremental_plan, run_full_refresh, run_incremental
from barlake.schemas import DAILY_KLINE
from barlake.session import scratch_path
from barlake.storage import tables
from barlake.storage.anchors import read_adjusted
from barlake.streaming.ingest import stream_upsert_bars
from tests.conftest import by_key

RAW = "ts_code STRING, trade_date DATE, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, vol DOUBLE, amount DOUBLE, ingest_seq BIGINT"


def test_plan_of_reads(frame):
    pool = frame("ts_code STRING", [("new",), ("behind",), ("current",), ("old",)])
    stored = frame("ts_code STRING, trade_date DATE", [("behind", "2026-06-12"), ("behind", "2026-06-01"), ("current", "2026-06-16"), ("old", "2026-01-03")])
    got = {r.ts_code: str(r.start_date) for r in incremental_plan(pool, stored, "2026-01-01", "2026-06-16").collect()}
    assert got == {"new": "2026-01-01", "behind": "2026-06-02", "old": "2026-01-01"}
    assert incremental_plan(pool, None, "2026-01-01", "2026-06-16").count() == 4


@pytest.mark.parametrize("seed", [1, 2])
def test_incremental_runs_equal_one_full_run(spark, frame, seed):
    """Three daily-style runs end in the state of a single clean over everything."""
    rng = random.Random(seed)
    day = lambda i: f"2026-{1 + i // 28:02d}-{1 + i % 28:02d}"
    rows, factors = [], []
    for code in ("000001.SZ", "600000.SH", "920000.BJ"):
        for i in range(84):
            if rng.random() < 0.8:
                price = lambda: None if rng.random() < 0.15 else round(rng.uniform(1, 30), 2)
                rows.append((code, day(i), price(), price(), price(), price(), rng.choice((0.0, 9.0)), 1.0, i))
            if rng.random() < 0.06:
                factors.append((code, day(i), round(rng.uniform(1, 3), 2)))
    landed, factor_df = frame(RAW, rows), frame("ts_code STRING, trade_date DATE, adj_factor DOUBLE", factors)
    days = frame("trade_date DATE", [(day(i),) for i in range(84) if i % 7 < 5])
    pool = landed.select("ts_code").distinct()
    path = scratch_path(spark, "incremental")
    tables.init_table(spark, path, DAILY_KLINE)
    for step, end in enumerate((day(30), day(55), day(83))):
        known = lambda df: df.filter(F.col("trade_date") <= F.lit(end).cast("date"))  # noqa: B023, E731
        args = (spark, path, known(landed), pool, known(factor_df), days, day(0), end)
        (run_full_refresh if step == 0 else run_incremental)(*args)
    columns = [c for c in DAILY_KLINE.columns if not c.startswith("raw_")]
    got = read_adjusted(spark, path).select(*columns)
    want = clean_and_adjust(landed, factor_df, days).select(*columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    # the last adjusted price is the raw price
    last = got.groupBy("ts_code").agg(F.max_by("close", "trade_date").alias("c"), F.max_by("adj_close_qfq", "trade_date").alias("q"))
    assert all(r.q is None or r.q == pytest.approx(r.c) for r in last.collect())


def test_late_correction_inside_the_overlap_is_picked_up(spark, frame):
    path = scratch_path(spark, "late")
    tables.init_table(spark, path, DAILY_KLINE)
    days = frame("trade_date DATE", [(f"2026-06-{x:02d}",) for x in range(1, 20)])
    no_factors = frame("ts_code STRING, trade_date DATE, adj_factor DOUBLE", [])
    pool = frame("ts_code STRING", [("a",)])
    bar = lambda x, p, seq=1: ("a", f"2026-06-{x:02d}", p, p, p, p, 1.0, 1.0, seq)
    run_full_refresh(spark, path, frame(RAW, [bar(1, 10.0), bar(2, 10.0), bar(15, 10.0)]), pool, no_factors, days, "2026-06-01", "2026-06-15")
    corrected = frame(RAW, [bar(1, 99.0), bar(2, 99.0), bar(15, 11.0), bar(16, 12.0)])
    assert run_incremental(spark, path, corrected, pool, no_factors, days, "2026-06-01", "2026-06-16") > 0
    got = by_key(tables.read_table(spark, path, DAILY_KLINE))
    assert got[("a", "2026-06-02")].close == 10.0  # older than the overlap
    assert got[("a", "2026-06-15")].close == 11.0 and got[("a", "2026-06-15")].pct_chg == pytest.approx(10.0)
    assert got[("a", "2026-06-10")].flag_aligned and got[("a", "2026-06-10")].close == 10.0
    assert run_incremental(spark, path, corrected, pool, no_factors, days, "2026-06-01", "2026-06-16") == 0  # up to date


def test_stream_reads_each_file_once_and_survives_a_replay(spark, frame):
    landing, path = scratch_path(spark, "landing"), scratch_path(spark, "streamed")
    schema = frame(RAW, []).schema
    bar = lambda code, day, p, seq: (code, day, p, p, p, p, 1.0, 1.0, seq)

    def ingest(checkpoint):
        stream_upsert_bars(spark, landing, schema, path, checkpoint, files_per_batch=1).awaitTermination()
        return {k: r.close for k, r in by_key(tables.read_table(spark, path, DAILY_KLINE)).items()}

    checkpoint = scratch_path(spark, "checkpoint")
    frame(RAW, [bar("a", "2026-06-15", 2.0, 2), bar("a", "2026-06-15", 1.0, 1)]).coalesce(1).write.mode("append").parquet(landing)
    assert ingest(checkpoint) == {("a", "2026-06-15"): 1.0}
    frame(RAW, [bar("a", "2026-06-15", 5.0, 3), bar("b", "2026-07-15", 7.0, 4)]).coalesce(1).write.mode("append").parquet(landing)
    want = {("a", "2026-06-15"): 5.0, ("b", "2026-07-15"): 7.0}
    assert ingest(checkpoint) == want
    assert ingest(checkpoint) == want  # nothing new
    assert set(ingest(scratch_path(spark, "lost"))) == set(want)  # everything read again: no doubled keys


@pytest.mark.parametrize("files_per_batch", [1, None])
def test_stream_result_does_not_depend_on_batching(spark, frame, files_per_batch):
    landing, path = scratch_path(spark, "landing"), scratch_path(spark, "streamed")
    schema = RAW + ", landing_id INT"
    bar = lambda p, seq, landed: ("a", "2026-06-15", p, p, p, p, 1.0, 1.0, seq, landed)
    for rows in ([bar(1.0, 1, 1), bar(2.0, 2, 1)], [bar(4.0, 9, 2), bar(3.0, 8, 2)]):
        frame(schema, rows).coalesce(1).write.mode("append").parquet(landing)
    stream = stream_upsert_bars(
        spark, landing, frame(schema, []).schema, path, scratch_path(spark, "cp"), landing_id="landing_id", files_per_batch=files_per_batch
    )
    stream.awaitTermination()
    assert [r.close for r in tables.read_table(spark, path, DAILY_KLINE).collect()] == [3.0]


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_cleaning_a_stored_table_takes_one_shuffle_of_the_bars(spark, frame, tmp_path):
    frame(RAW, []).drop("ingest_seq").write.parquet(f"{tmp_path}/bars")
    bars = spark.read.parquet(f"{tmp_path}/bars")
    days = frame("trade_date DATE", [("2026-06-15",)])
    plan = plan_text(clean_bars(bars, days, order=None))
    assert plan.count("Exchange hashpartitioning(ts_code") == 1
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_dedup_combines_before_its_shuffle(frame):
    plan = plan_text(clean_bars(frame(RAW, [])))
    assert "partial_min_by" in plan and "Exchange hashpartitioning(ts_code" in plan


TESTDATA = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not TESTDATA.exists(), reason="driver tables not here")
def test_driver_contract(spark):
    import __spark_entry__ as entry
    from verification.check import compare, connect
    from verification.queries import QUERIES

    # queries of packages that may be absent are checked by their own tests
    assert set(QUERIES) <= set(entry.oracle_sql()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert {"ts_code", "is_in_universe"} <= set(entry.entry(spark).columns)
    con = connect(str(TESTDATA))
    for name in ("clean_bars", "research_universe_view", "quality_report", "upsert_bars_partial", "st_interval_join"):
        assert compare(spark, con, str(TESTDATA), name)[0] == "ok", name
