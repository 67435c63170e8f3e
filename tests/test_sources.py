from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from barlake.sources import frames, instruments, payloads, routing
from tests.conftest import by_key


def responses(spark, **bodies):
    rows = [(symbol.strip("s"), body if isinstance(body, str) else json.dumps(body)) for symbol, body in bodies.items()]
    return spark.createDataFrame(rows, "symbol STRING, payload STRING")


def test_nested_array_payload(spark):
    day = [
        ["2026-06-16", "11.0", "11.5", "12", "10.5", "300", {"extra": 1}],
        ["2026-06-12", "10", "10.0", "10.2", "9.9", "100"],
        ["2026-06-15", "10", "10", "10"],
        ["2026-06-17", "11.0", "--", "12", "10.5", "300"],
    ]
    body = {"code": 0, "msg": "", "data": {"sz000001": {"day": day, "version": "16", "qt": {"x": [1]}}}}
    frame = responses(
        spark, s000001=body, s920000=body, s600000={"code": 1, "data": {}}, s600001="not json", s600002={"code": 0, "data": {"sh600002": {"qfqday": day}}}
    )
    got = by_key(payloads.nested_array_bars(frame))
    assert set(got) == {("000001.SZ", f"2026-06-{x}") for x in (12, 16, 17)}
    bar = got[("000001.SZ", "2026-06-16")]
    assert (bar.open, bar.close, bar.high, bar.low, bar.vol) == (11.0, 11.5, 12.0, 10.5, 30000.0)
    assert bar.pct_chg == pytest.approx(15.0) and bar.raw_close == 11.5 and bar.amount is None and bar.adj_factor is None
    assert got[("000001.SZ", "2026-06-17")].close is None
    # the return is taken before the range is cut
    assert payloads.nested_array_bars(frame, "2026-06-16", "2026-06-16").first().pct_chg == pytest.approx(15.0)
    adjusted = payloads.nested_array_bars(frame, price_type="qfq")
    assert "raw_close" not in adjusted.columns and {r.price_type for r in adjusted.collect()} == {"qfq"}
    assert {r.ts_code for r in adjusted.collect()} == {"600002.SH"}


def test_csv_line_payload(spark):
    lines = ["2026-06-15,11.1,11.06,11.2,11.0,1541304.95,1711561286.57,1.8,-0.45,-0.05,0.79", "2026-06-16,11,11.2", "2026-06-17,,x,1,1,1,1,1,1,1,1"]
    got = by_key(payloads.csv_line_bars(responses(spark, s000001={"rc": 0, "data": {"klines": lines}}, s000002={"rc": 0, "data": None})))
    assert set(got) == {("000001.SZ", "2026-06-15"), ("000001.SZ", "2026-06-17")}
    bar = got[("000001.SZ", "2026-06-15")]
    assert (bar.close, bar.high, bar.amount, bar.pct_chg, bar.raw_open) == (11.06, 11.2, 1711561286.57, -0.45, 11.1)
    assert bar.vol == pytest.approx(154130495.0)
    assert got[("000001.SZ", "2026-06-17")].open is None


def test_object_array_payload(spark, tmp_path):
    rows = [
        {"day": "2026-06-15", "open": "11.1", "high": "11.2", "low": "11.0", "close": "11.06", "volume": "154130495"},
        {"day": "2026-06-16", "open": "--", "high": "11.2", "low": "11.0", "close": "11.10", "volume": "1"},
        {"day": "2026-06-30", "open": "1", "high": "1", "low": "1", "close": "1", "volume": "1"},
    ]
    (tmp_path / "landed.txt").write_text(f"000001\t{json.dumps(rows)}\n600000\t[]\n")
    landed = payloads.read_payloads(spark, str(tmp_path))
    got = by_key(payloads.object_array_bars(landed, "2026-06-15", "2026-06-16"))
    bar = got[("000001.SZ", "2026-06-15")]
    assert len(got) == 2 and (bar.close, bar.vol, bar.amount) == (11.06, 154130495.0, None)
    assert got[("000001.SZ", "2026-06-16")].open is None


def test_localised_headers(spark):
    schema = "symbol STRING, `日期` STRING, `开盘` STRING, `收盘` STRING, `最高` STRING, `最低` STRING, `成交量` STRING, `成交额` STRING, `涨跌幅` STRING"
    df = spark.createDataFrame([("000001", "2026-06-15", "11.1", "11.06", "11.2", "11", "5", "6.5", "-0.4")], schema)
    bar = frames.localized_bars(df).first()
    assert (bar.ts_code, str(bar.trade_date), bar.close, bar.vol, bar.pct_chg) == ("000001.SZ", "2026-06-15", 11.06, 5.0, -0.4)
    assert frames.localized_bars(df.drop("成交量")).count() == 0
    assert frames.localized_bars(df.drop("成交额")).count() == 1


def test_dated_frames(frame):
    daily = frame("ts_code STRING, trade_date STRING, close DOUBLE, amount STRING", [("a", "20260615", 1.0, "12.3"), ("b", "20260616", 1.0, "?")])
    got = by_key(frames.dated_string_bars(daily))
    assert got[("a", "2026-06-15")].amount == 12300.0 and got[("b", "2026-06-16")].amount is None
    cal = frame("cal_date STRING, is_open STRING", [("20260615", "1")])
    assert tuple(frames.calendar_feed(cal).select("trade_date", "is_open").first())[1] == 1
    factor = frame("ts_code STRING, trade_date STRING, adj_factor DOUBLE", [("a", "20260615", 2.0)])
    assert by_key(frames.adjustment_factors(factor))[("a", "2026-06-15")].adj_factor == 2.0
    report = frame("ts_code STRING, ann_date STRING, end_date STRING, dt_debt_to_assets DOUBLE", [("a", "20260430", "20260331", 0.5)])
    got = frames.financials(report).first()
    assert (str(got.ann_date), str(got.end_date), got.dt_debt_ratio) == ("2026-04-30", "2026-03-31", 0.5)


def test_name_history(frame):
    rows = [("a", "plain", "20200101", "20201231", None), ("a", "*St x", "20210101", None, None), ("a", None, "20220101", "bad", "became st"), ("a", "x", "20230101", "", "")]
    df = frame("ts_code STRING, name STRING, start_date STRING, end_date STRING, change_reason STRING", rows)
    got = frames.name_history(df).orderBy("start_date").collect()
    assert [r.is_st for r in got] == [False, True, True, False]
    assert [str(r.start_date) for r in got][1] == "2021-01-01" and got[2].end_date is None


def test_instrument_lists(frame):
    codes = frame("code STRING, name STRING", [("920000", "x"), ("1", "y"), ("600000", "z"), ("500000", "dropped")])
    got = {r.symbol: (r.ts_code, r.exchange, r.list_status, r.list_date) for r in instruments.from_bare_codes(codes).collect()}
    assert got == {"920000": ("920000.BJ", "BSE", "L", None), "000001": ("000001.SZ", "SZSE", "L", None), "600000": ("600000.SH", "SSE", "L", None)}
    schema = "ts_code STRING, list_date STRING, delist_date STRING"
    listed = frame(schema, [("000001.SZ", "19910403", None), ("000004.SZ", "19910403", None)])
    delisted = frame(schema, [("000003.SZ", "19910703", "20020614"), ("000004.SZ", "bad", "20020614")])
    both = instruments.union_listed_delisted(listed, delisted).collect()
    assert sorted((r.ts_code, r.list_status) for r in both) == [("000001.SZ", "L"), ("000003.SZ", "D"), ("000004.SZ", "D"), ("000004.SZ", "D")]
    assert {str(r.delist_date) for r in both if r.ts_code == "000003.SZ"} == {"2002-06-14"}


def test_priority_and_union(frame):
    schema = "ts_code STRING, trade_date DATE, close DOUBLE"
    first = frame(schema, [("a", "2026-06-15", 1.0)])
    second = frame(schema, [("a", "2026-06-15", 2.0), ("a", "2026-06-16", 2.0), ("b", "2026-06-15", 3.0)]).withColumn("amount", F.lit(9.0))
    got = sorted((r.ts_code, r.close, r.source, r.amount) for r in routing.pick_by_priority({"x": first, "y": second}).collect())
    assert got == [("a", 1.0, "x", None), ("b", 3.0, "y", 9.0)]
    assert routing.union_batches(first, second).count() == 4
