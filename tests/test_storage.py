from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from barlake.operators import lookups
from barlake.operators.universe import universe_on
from barlake.plans.incremental import bars_at
from barlake.schemas import DAILY_BASIC, DAILY_KLINE, STOCK_NAME_HISTORY, TABLES
from barlake.session import scratch_path, shared_dir
from barlake.storage import tables, upserts
from barlake.storage.store import init_store, open_store
from tests.conftest import by_key

CLOSE = "ts_code STRING, trade_date DATE, close DOUBLE"


@pytest.fixture
def table(spark):
    path = scratch_path(spark, "kline")
    tables.init_table(spark, path, DAILY_KLINE)
    return path


def state(spark, path):
    return by_key(tables.read_table(spark, path, DAILY_KLINE))


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


@pytest.mark.parametrize("name", sorted(TABLES))
def test_partition_is_a_function_of_the_key(spark, name):
    spec = TABLES[name]
    empty = spark.createDataFrame([], spec.schema)
    if name == "pipeline_log":  # appended, never upserted by key
        return
    assert empty.select(*spec.key).withColumn(spec.partition, spec.partition_value()).count() == 0


def test_insert_update_and_untouched_months(spark, table, frame):
    first = frame(CLOSE + ", vol DOUBLE", [("a", "2026-01-30", 1.0, 5.0), ("a", "2026-02-02", 2.0, 5.0), ("a", "2026-03-02", 3.0, 5.0)])
    assert upserts.upsert_bars(spark, table, first) == 3
    assert upserts.upsert_bars(spark, table, frame(CLOSE, [("a", "2026-02-02", 20.0), ("b", "2026-02-03", None)])) == 2
    got = state(spark, table)
    assert {k: r.close for k, r in got.items()} == {
        ("a", "2026-01-30"): 1.0, ("a", "2026-02-02"): 20.0, ("a", "2026-03-02"): 3.0, ("b", "2026-02-03"): None,
    }
    assert got[("a", "2026-02-02")].vol == 5.0  # not in the batch: kept
    assert got[("b", "2026-02-03")].flag_extreme is False  # default of a new row
    upserts.upsert_bars(spark, table, first.withColumn("vol", F.lit(None).cast("double")))
    assert state(spark, table)[("a", "2026-01-30")].vol is None  # in the batch: overwritten, also by NULL


def test_upsert_is_idempotent_and_keys_stay_unique(spark, table, frame):
    batch = frame(CLOSE + ", seq INT", [("a", "2026-01-30", 1.0, 2), ("a", "2026-01-30", 9.0, 1), ("b", "2026-01-30", 1.0, 3)])
    for _ in range(2):
        assert upserts.upsert_bars(spark, table, batch, order="seq") == 2
    rows = tables.read_table(spark, table, DAILY_KLINE)
    assert rows.count() == rows.select("ts_code", "trade_date").distinct().count() == 2
    assert state(spark, table)[("a", "2026-01-30")].close == 9.0


def test_required_columns(spark, table, frame):
    assert upserts.upsert_bars_fixed(spark, table, frame("ts_code STRING, trade_date DATE", [("a", "2026-01-30")])) == 0
    with pytest.raises(ValueError, match="missing columns"):
        upserts.upsert_bars(spark, table, frame("ts_code STRING", [("a",)]))
    assert upserts.upsert_bars(spark, table, frame(CLOSE, [])) == 0


def test_old_files_without_a_flag(spark, frame):
    path = scratch_path(spark, "old")
    old = frame(CLOSE + ", flag_extreme BOOLEAN, trade_month STRING", [("a", "2026-01-30", 1.0, None, "2026-01")])
    old.write.partitionBy("trade_month").parquet(path)
    row = tables.read_table(spark, path, DAILY_KLINE).first()
    assert (row.flag_invalid_ohlc, row.flag_extreme, row.raw_close) == (False, False, None)


def test_range_read_prunes_months(spark, table, frame):
    upserts.upsert_bars(spark, table, frame(CLOSE, [("a", f"2026-{m:02d}-10", 1.0) for m in range(1, 7)]))
    part = tables.read_bars(spark, table, DAILY_KLINE, "2026-02-05", "2026-03-15")
    assert sorted(r.trade_date.month for r in part.collect()) == [2, 3]
    scan = [x for x in part._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x]
    assert "PartitionFilters: [isnotnull(trade_month" in scan[0] and "PushedFilters: [IsNotNull(trade_date)" in scan[0]


def scans(df):
    return [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x]


def test_day_lookups_prune_months_of_a_store(spark, frame, tmp_path):
    init_store(spark, str(tmp_path))
    many = frame(CLOSE, [("a", f"2026-{m:02d}-10", float(m)) for m in range(1, 7)])
    upserts.upsert_bars(spark, f"{tmp_path}/daily_kline", many)
    basics = many.select("ts_code", "trade_date", F.col("close").alias("pe"))
    tables.upsert(spark, f"{tmp_path}/daily_basic", DAILY_BASIC, basics)
    store = open_store(spark, str(tmp_path))
    day = lookups.cross_section(store["daily_kline"], store["daily_basic"], "2026-03-10")
    one = lookups.daily_range(store["daily_kline"], "a", "2026-02-01", "2026-03-31")
    members = universe_on(store["research_daily_universe"], "2026-03-10", only_in_universe=False)
    recent = bars_at(store["daily_kline"], frame("ts_code STRING, trade_date DATE", [("a", "2026-05-10")]))
    for df, n in ((day, 2), (one, 1), (members, 1), (recent, 1)):  # plans first: afterwards they show two versions
        pruned = [x for x in scans(df) if "PartitionFilters: [isnotnull(trade_month" in x]
        assert len(pruned) == n, scans(df)
    assert [(r.close, r.pe) for r in day.collect()] == [(3.0, 3.0)] and "trade_month" not in day.columns
    assert [r.close for r in one.collect()] == [2.0, 3.0]
    assert [r.close for r in members.collect()] == [3.0]
    assert [r.close for r in recent.collect()] == [5.0]


def test_files_of_a_month_hold_ranges_of_codes(spark, table, frame):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        upserts.upsert_bars(spark, table, frame(CLOSE, [(f"{i:04d}.SZ", "2026-01-05", 1.0) for i in range(400)]))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = tables.read_table(spark, table, DAILY_KLINE).groupBy(F.input_file_name().alias("f"))
    spans = sorted(tuple(r)[1:] for r in files.agg(F.min("ts_code"), F.max("ts_code")).collect())
    assert len(spans) > 1 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_calendar_and_instruments_keep_insert_only_columns(spark, frame):
    cal = scratch_path(spark, "cal")
    from barlake.schemas import STOCK_LIST, TRADE_CALENDAR

    tables.init_table(spark, cal, TRADE_CALENDAR)
    upserts.upsert_calendar(spark, cal, frame("trade_date DATE, is_open INT, pretrade_date DATE", [("2026-01-05", 1, "2026-01-02")]))
    upserts.upsert_calendar(spark, cal, frame("trade_date DATE, is_open INT, pretrade_date DATE", [("2026-01-05", 0, "2025-01-01"), ("2026-01-06", 1, None)]))
    got = by_key(tables.read_table(spark, cal, TRADE_CALENDAR), "trade_date")
    assert (got[("2026-01-05",)].is_open, str(got[("2026-01-05",)].pretrade_date)) == (0, "2026-01-02")
    assert (got[("2026-01-06",)].day_of_week, got[("2026-01-06",)].week_of_year) == (1, 2)

    path = scratch_path(spark, "list")
    tables.init_table(spark, path, STOCK_LIST)
    schema = "ts_code STRING, symbol STRING, name STRING, exchange STRING, list_status STRING"
    upserts.upsert_instruments(spark, path, frame(schema, [("000001.SZ", "000001", "x", "SZSE", "L")]), "2026-01-01 00:00:00")
    upserts.upsert_instruments(spark, path, frame(schema, [("000001.SZ", "other", "y", "SZSE", "D"), ("600000.SH", "600000", "z", "SSE", "L")]), "2026-02-01 00:00:00")
    got = by_key(tables.read_table(spark, path, STOCK_LIST), "ts_code")
    row = got[("000001.SZ",)]
    assert (row.symbol, row.name, row.list_status, row.created_at.month, row.updated_at.month) == ("000001", "y", "D", 1, 1)
    assert got[("600000.SH",)].created_at.month == 2


def test_history_and_audit_rows(spark, frame):
    path = scratch_path(spark, "hist")
    tables.init_table(spark, path, STOCK_NAME_HISTORY)
    rows = frame("ts_code STRING, name STRING, start_date DATE, end_date DATE, change_reason STRING, is_st BOOLEAN", [("a", "*ST", "2026-01-01", None, "ST", True)])
    for _ in range(2):
        upserts.upsert_name_history(spark, path, rows)
    assert [r.is_st for r in tables.read_table(spark, path, STOCK_NAME_HISTORY).collect()] == [True]


def test_rebuild_leaves_the_old_table(spark, table, frame):
    upserts.upsert_bars(spark, table, frame(CLOSE, [("a", "2026-01-30", 1.0)]))
    fresh = frame(CLOSE, [("b", "2026-01-30", 2.0)])
    missing = {c: F.lit(None).cast(DAILY_KLINE.schema[c].dataType) for c in DAILY_KLINE.columns if c not in fresh.columns}
    new_path = scratch_path(spark, "rebuilt")
    assert [r.ts_code for r in tables.rebuild(spark, new_path, DAILY_KLINE, fresh.withColumns(missing)).collect()] == ["b"]
    assert set(state(spark, table)) == {("a", "2026-01-30")}
