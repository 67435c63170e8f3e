from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from barlake.functions.dates import day
from barlake.operators.adjust import join_factors
from barlake.operators.series import dedup_first
from barlake.plans import incremental
from barlake.schemas import DAILY_KLINE, STOCK_LIST
from barlake.storage import upserts
from barlake.storage.anchors import current_anchors, read_adjusted
from barlake.storage.tables import init_table, read_table, rejected_rows, upsert

HISTORY = "ts_code STRING, name STRING, start_date DATE, end_date DATE, change_reason STRING, is_st BOOLEAN"


def test_rows_without_a_key_are_rejected_and_kept_apart(spark, frame, tmp_path):
    from barlake.schemas import STOCK_NAME_HISTORY

    path = str(tmp_path / "history")
    init_table(spark, path, STOCK_NAME_HISTORY)
    for code in ("A.SZ", "B.SZ"):
        rows = [(code, "old", None, None, "x", False), (code, "new", "2024-01-02", None, "x", False)]
        assert upserts.upsert_name_history(spark, path, frame(HISTORY, rows)) == 1
    stored = read_table(spark, path, STOCK_NAME_HISTORY).collect()
    assert sorted(r.ts_code for r in stored) == ["A.SZ", "B.SZ"]
    refused = rejected_rows(spark, path).collect()
    assert len(refused) == 2 and all("key" in r.reason for r in refused)


def test_a_batch_that_repeats_a_key_is_refused(spark, bars, tmp_path):
    path = str(tmp_path / "bars")
    init_table(spark, path, DAILY_KLINE)
    row = ("A.SZ", "2024-01-03", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)
    with pytest.raises(ValueError, match="repeats a key"):
        upsert(spark, path, DAILY_KLINE, bars([row, row]), unique=True)
    assert read_table(spark, path, DAILY_KLINE).count() == 0


def test_rows_without_a_key_are_not_taken_for_repeats(spark, frame, tmp_path):
    path = str(tmp_path / "bars")
    init_table(spark, path, DAILY_KLINE)
    rows = [("A.SZ", None, 1.0), ("A.SZ", None, 2.0), ("A.SZ", None, 2.0), ("A.SZ", "2024-01-03", 3.0)]
    assert upsert(spark, path, DAILY_KLINE, frame("ts_code STRING, trade_date DATE, close DOUBLE", rows)) == 1
    refused = rejected_rows(spark, path).collect()
    assert sorted(json.loads(r.row)["close"] for r in refused) == [1.0, 2.0]


def test_repeated_keys_without_order_resolve_the_same_way(spark, frame, tmp_path):
    rows = [("A.SZ", "2024-01-03", float(i)) for i in range(40)]
    seen = set()
    for n in (1, 7):
        path = str(tmp_path / f"bars{n}")
        init_table(spark, path, DAILY_KLINE)
        upsert(spark, path, DAILY_KLINE, frame("ts_code STRING, trade_date DATE, close DOUBLE", rows).repartition(n))
        seen.add(read_table(spark, path, DAILY_KLINE).first().close)
    assert len(seen) == 1


def test_repeated_factors_do_not_multiply_bars(frame, bars):
    row = ("A.SZ", "2024-01-03", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)
    factors = "ts_code STRING, trade_date DATE, adj_factor DOUBLE"
    twice = [("A.SZ", "2024-01-03", 2.0), ("A.SZ", "2024-01-03", 2.0)]
    assert join_factors(bars([row]), frame(factors, twice)).count() == 1
    ordered = frame(factors + ", ingest_seq LONG", [("A.SZ", "2024-01-03", 2.0, 5), ("A.SZ", "2024-01-03", 3.0, 1)])
    assert join_factors(bars([row]), ordered).first().adj_factor == 3.0


def test_rows_without_arrival_order_come_last_and_stay_whole(frame):
    schema = "ts_code STRING, trade_date DATE, close DOUBLE, ingest_seq LONG"
    rows = [("A", "2024-01-03", 1.0, None), ("B", "2024-01-03", 2.0, None), ("B", "2024-01-03", 3.0, 9)]
    got = {r.ts_code: r.close for r in dedup_first(frame(schema, rows)).collect()}
    assert got == {"A": 1.0, "B": 3.0}


def test_day_takes_the_whole_text_or_nothing(frame):
    texts = ["2024-1-15 10:00", "20240105999", "202401051", "2024-1-5", "2024-01-05 10:00", "20240105T10:00:00Z", "2024-01-05x", " "]
    got = [r.d for r in frame("t STRING", [(t,) for t in texts]).select(day("t").alias("d")).collect()]
    assert got == [None, None, None, None, dt.date(2024, 1, 5), dt.date(2024, 1, 5), None, None]


def test_unknown_markets_share_a_partition(spark, frame, tmp_path):
    path = str(tmp_path / "stocks")
    init_table(spark, path, STOCK_LIST)
    rows = [("000001.SZ",), ("000002",), ("000003",), ("X.US",)]
    upserts.upsert_instruments(spark, path, frame("ts_code STRING", rows), "2024-01-01 00:00:00")
    markets = {r.ts_code: r.market for r in read_table(spark, path, STOCK_LIST).collect()}
    assert markets == {"000001.SZ": "SZ", "000002": "other", "000003": "other", "X.US": "other"}


FACTOR = "ts_code STRING, trade_date DATE, adj_factor DOUBLE"


def bar_files(spark, path) -> dict[str, set[str]]:
    """The Parquet files that now make up each month."""
    found: dict[str, set[str]] = {}
    for file in read_table(spark, str(path), DAILY_KLINE).inputFiles():
        found.setdefault(file.split("/")[-2], set()).add(file)
    return found


@pytest.mark.parametrize("factor_days", [("2024-01-02", "2024-01-04"), ("2024-01-04",)])
@pytest.mark.parametrize("broken_write", ["upsert", "late_first_factors", "save_anchors"])
def test_a_run_that_broke_off_is_made_good(spark, frame, bars, tmp_path, monkeypatch, broken_write, factor_days):
    """Broken at its bars, at late first factors, or at its anchors: the next run ends where a clean one does."""
    late = len(factor_days) == 1
    if broken_write == "late_first_factors" and not late:
        pytest.skip("no instrument gets its first factor late")
    days = frame("trade_date DATE", [("2023-12-01",), ("2023-12-28",), *[(f"2024-01-{n:02}",) for n in (2, 3, 4)]])
    pool = frame("ts_code STRING", [("A.SZ",)])
    at = ("2023-12-01", "2023-12-28", "2024-01-02", "2024-01-03", "2024-01-04")
    feed = bars([("A.SZ", x, 10.0, 10.0, 10.0, 10.0, 1.0, 1.0) for x in at]).withColumn("ingest_seq", F.lit(1).cast("long"))
    factors = frame(FACTOR, [("A.SZ", x, float(i + 1)) for i, x in enumerate(factor_days)])

    def prices(path: str) -> list:
        stored = read_adjusted(spark, path).select("trade_date", "adj_factor", "adj_close_qfq")
        return [tuple(r) for r in stored.orderBy("trade_date").collect()]

    def run(path: str, end: str) -> None:
        known = factors.filter(F.col("trade_date") <= F.lit(end).cast("date"))
        incremental.run_incremental(spark, path, feed, pool, known, days, "2023-12-01", end)

    clean, broken = str(tmp_path / "clean"), str(tmp_path / "broken")
    for path in (clean, broken):
        init_table(spark, path, DAILY_KLINE)
        run(path, "2024-01-03")
    run(clean, "2024-01-04")

    def failing(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(incremental, broken_write, failing)
        with pytest.raises(RuntimeError, match="lost"):
            run(broken, "2024-01-04")
    run(broken, "2024-01-04")
    assert prices(broken) == prices(clean)
    assert {p for *_, p in prices(clean)} == ({10.0} if late else {5.0, 10.0})


def test_a_new_factor_rewrites_no_older_month(spark, frame, bars, tmp_path):
    path = tmp_path / "bars"
    init_table(spark, str(path), DAILY_KLINE)
    at = [f"2024-{m:02}-{n:02}" for m in range(1, 8) for n in (2, 25)]
    days, pool = frame("trade_date DATE", [(x,) for x in at]), frame("ts_code STRING", [("A.SZ",), ("B.SZ",)])
    feed = bars([(c, x, 10.0, 10.0, 10.0, 10.0, 1.0, 1.0) for c in ("A.SZ", "B.SZ") for x in at]).withColumn("ingest_seq", F.lit(1).cast("long"))
    first = [("A.SZ", at[0], 1.0), ("B.SZ", at[0], 1.0)]
    incremental.run_full_refresh(spark, str(path), feed, pool, frame(FACTOR, first), days, at[0], at[-2])
    before = bar_files(spark, path)
    incremental.run_incremental(spark, str(path), feed, pool, frame(FACTOR, [*first, ("A.SZ", at[-1], 2.0)]), days, at[0], at[-1])
    after = bar_files(spark, path)
    assert len(before) == 7
    # the overlap reaches back ten days from the last stored bar, into June
    assert all(after[m] == before[m] for m in before if m < "trade_month=2024-06")
    got = {(r.ts_code, str(r.trade_date)): r.adj_close_qfq for r in read_adjusted(spark, str(path)).collect()}
    assert got[("A.SZ", at[0])] == 5.0 and got[("A.SZ", at[-1])] == 10.0 and got[("B.SZ", at[0])] == 10.0


def test_a_refresh_from_a_later_day_moves_the_anchor_of_older_bars(spark, frame, bars, tmp_path):
    path = str(tmp_path / "bars")
    init_table(spark, path, DAILY_KLINE)
    at = ["2024-01-02", "2024-02-02", "2024-03-04"]
    days, pool = frame("trade_date DATE", [(x,) for x in at]), frame("ts_code STRING", [("A.SZ",)])
    feed = bars([("A.SZ", x, 10.0, 10.0, 10.0, 10.0, 1.0, 1.0) for x in at]).withColumn("ingest_seq", F.lit(1).cast("long"))
    factors = frame(FACTOR, [("A.SZ", at[0], 1.0), ("A.SZ", at[2], 4.0)])
    incremental.run_full_refresh(spark, path, feed, pool, factors.filter("adj_factor < 2"), days, at[0], at[1])
    incremental.run_full_refresh(spark, path, feed, pool, factors, days, at[2], at[2])
    assert [r.adj_close_qfq for r in read_adjusted(spark, path).orderBy("trade_date").collect()] == [2.5, 2.5, 10.0]


def test_bars_written_another_way_are_anchored_when_first_asked(spark, frame, tmp_path):
    path = str(tmp_path / "bars")
    init_table(spark, path, DAILY_KLINE)
    rows = [("A.SZ", "2024-01-02", 1.0), ("A.SZ", "2024-01-03", 2.0), ("A.SZ", "2024-01-04", None)]
    upsert(spark, path, DAILY_KLINE, frame(FACTOR, rows))
    assert [tuple(r) for r in current_anchors(spark, path).collect()] == [("A.SZ", dt.date(2024, 1, 4), 2.0)]
