"""A write is seen whole or not at all, and computes its rows once."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from barlake.schemas import DAILY_KLINE
from barlake.session import scratch_path
from barlake.storage import tables, upserts, versions
from tests.conftest import by_key

CLOSE = "ts_code STRING, trade_date DATE, close DOUBLE"


def closes(df) -> dict:
    return {k: r.close for k, r in by_key(df).items()}


@pytest.fixture
def table(spark, frame):
    path = scratch_path(spark, "kline")
    tables.init_table(spark, path, DAILY_KLINE)
    upserts.upsert_bars(spark, path, frame(CLOSE, [("a", "2026-01-05", 1.0), ("a", "2026-02-05", 1.0)]))
    return path


OLD = {("a", "2026-01-05"): 1.0, ("a", "2026-02-05"): 1.0}


def test_a_write_that_dies_between_two_months_changes_nothing(spark, frame, table, monkeypatch):
    batch = frame(CLOSE, [("a", "2026-01-05", 2.0), ("a", "2026-02-05", 2.0)])
    laid_out = tables.laid_out
    written = []

    def dying(rows, spec, bounds, files):
        # January's file is written, then February's task fails for good
        bad = F.when(F.col("trade_date") >= F.lit("2026-02-01").cast("date"), F.raise_error(F.lit("lost"))).otherwise(F.col("close"))
        early = laid_out(rows.filter("trade_date < DATE '2026-02-01'"), spec, bounds, files)
        early.write.mode("append").partitionBy(spec.partition).parquet(f"{table}/{versions.version_folder(versions.current(spark, table))}")
        written.extend(Path(table).glob("version=*/trade_month=2026-01/*.parquet"))
        return laid_out(rows, spec, bounds, files).withColumn("close", bad)

    with monkeypatch.context() as patch:
        patch.setattr(tables, "laid_out", dying)
        with pytest.raises(Exception, match="lost"):
            upserts.upsert_bars(spark, table, batch)
    assert len(written) == 2  # the old file and one that no pointer names
    assert closes(tables.read_table(spark, table, DAILY_KLINE)) == OLD
    assert upserts.upsert_bars(spark, table, batch) == 2
    assert set(closes(tables.read_table(spark, table, DAILY_KLINE)).values()) == {2.0}


def test_a_frame_read_before_a_write_keeps_its_state(spark, frame, table):
    before = tables.read_table(spark, table, DAILY_KLINE)
    upserts.upsert_bars(spark, table, frame(CLOSE, [("a", "2026-01-05", 2.0)]))
    assert closes(before) == OLD
    assert closes(tables.read_table(spark, table, DAILY_KLINE)) == {**OLD, ("a", "2026-01-05"): 2.0}
    upserts.upsert_bars(spark, table, frame(CLOSE, [("a", "2026-01-05", 3.0)]))
    # what the first write held of January is gone, what both readers can still ask for is not
    januaries = [p for p in Path(table).glob("version=*/trade_month=2026-01")]
    assert len(januaries) == 2
    assert versions.current(spark, table).number == 3


def test_a_second_writer_is_refused(spark, frame, table, monkeypatch):
    laid_out = tables.laid_out

    def slow(*args):
        with monkeypatch.context() as patch:
            patch.setattr(tables, "laid_out", laid_out)
            upserts.upsert_bars(spark, table, frame(CLOSE, [("b", "2026-03-05", 9.0)]))
        return laid_out(*args)

    fresh = scratch_path(spark, "other")
    assert fresh != table
    monkeypatch.setattr(tables, "laid_out", slow)
    with pytest.raises(Exception):
        upserts.upsert_bars(spark, table, frame(CLOSE, [("a", "2026-01-05", 2.0)]))
    assert closes(tables.read_table(spark, table, DAILY_KLINE)) == {**OLD, ("b", "2026-03-05"): 9.0}


def test_a_plain_folder_is_taken_over(spark, frame):
    path = scratch_path(spark, "plain")
    rows = frame(CLOSE + ", trade_month STRING", [("a", "2026-01-05", 1.0, "2026-01"), ("a", "2026-02-05", 1.0, "2026-02")])
    rows.write.partitionBy("trade_month").parquet(path)
    assert closes(tables.read_table(spark, path, DAILY_KLINE)) == OLD
    upserts.upsert_bars(spark, path, frame(CLOSE, [("a", "2026-02-05", 5.0)]))
    assert closes(tables.read_table(spark, path, DAILY_KLINE)) == {**OLD, ("a", "2026-02-05"): 5.0}


def test_rebuild_needs_a_new_path(spark, frame, table):
    with pytest.raises(FileExistsError):
        tables.rebuild(spark, table, DAILY_KLINE, tables.read_table(spark, table, DAILY_KLINE))


@pytest.mark.parametrize("unique", [True, False])
def test_an_upsert_joins_once_and_counts_keys_only_where_they_can_repeat(spark, frame, table, monkeypatch, unique):
    plans = []
    laid_out = tables.laid_out

    def seen(*args):
        result = laid_out(*args)
        plans.append(result._jdf.queryExecution().executedPlan().toString())
        return result

    monkeypatch.setattr(tables, "laid_out", seen)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("upsert", "")
    upserts.upsert_bars(spark, table, frame(CLOSE, [("a", "2026-01-05", 2.0)]), unique=unique)
    assert len(tracker.getJobIdsForGroup("upsert")) > 0
    (plan,) = plans
    # no sample of the merged rows, so no second run of their join
    assert "rangepartitioning" not in plan and plan.count("FullOuter") == 1


def test_large_months_are_divided_by_keys(spark, frame, table, monkeypatch):
    monkeypatch.setattr(tables, "FILE_BYTES", 4000)
    batch = frame(CLOSE, [(f"{i:04d}", "2026-01-06", float(i)) for i in range(3000)] + [("a", "2026-03-06", 1.0)])
    assert upserts.upsert_bars(spark, table, batch) == 3001
    files = tables.read_table(spark, table, DAILY_KLINE).groupBy("trade_month", F.input_file_name().alias("f"))
    spans = sorted(tuple(r) for r in files.agg(F.min("ts_code"), F.max("ts_code")).drop("f").collect())
    january = [s for s in spans if s[0] == "2026-01"]
    assert len(january) > 2 and all(a[2] < b[1] for a, b in zip(january, january[1:]))
    assert [s[0] for s in spans if s[0] != "2026-01"] == ["2026-02", "2026-03"]
    assert tables.read_table(spark, table, DAILY_KLINE).count() == 3003
