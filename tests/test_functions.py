from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from barlake.functions.codes import exchange_of, symbol_of, ts_code_of, zero_pad
from barlake.functions.columns import clean_numeric, number
from barlake.functions.dates import business_days, calendar_parts, day, request_day


def values(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]


def test_zero_pad_never_cuts(frame):
    df = frame("c STRING", [("1",), ("600000",), ("1234567",), (None,)])
    assert values(df.select(zero_pad("c").alias("p")), "p") == [("000001",), ("600000",), ("1234567",), (None,)]


def test_exchange_and_code(frame):
    df = frame("s STRING", [("600000",), ("000001",), ("300001",), ("920000",), ("830000",), ("430000",), ("500000",)])
    out = df.select("s", exchange_of("s").alias("e"), ts_code_of("s").alias("c"), ts_code_of("s", None).alias("strict"))
    got = {r.s: (r.e, r.c, r.strict) for r in out.collect()}
    assert got["600000"] == ("SSE", "600000.SH", "600000.SH")
    assert got["000001"] == ("SZSE", "000001.SZ", "000001.SZ")
    assert got["300001"][0] == "SZSE"
    assert {got[s][0] for s in ("920000", "830000", "430000")} == {"BSE"}
    assert got["500000"] == (None, "500000.BJ", None)
    assert values(out.select(symbol_of("c").alias("x")).distinct(), "x").__len__() == 7


def test_dates(frame):
    df = frame("t STRING", [("20260615",), ("2026-06-15",), ("2026-06-15 00:00:00",), ("TODAY",), ("soon",), (None,)])
    june = dt.date(2026, 6, 15)
    assert [r[0] for r in df.select(day("t")).collect()] == [june, june, june, None, None, None]
    assert [r[0] for r in df.select(request_day("t", "2026-07-01")).collect()] == [june] * 3 + [dt.date(2026, 7, 1), None, None]


def test_numbers(frame):
    df = frame("t STRING", [("1.5",), ("--",), ("",), ("NaN",), ("Infinity",), (None,)])
    assert [r[0] for r in df.select(number("t")).collect()] == [1.5, None, None, None, None, None]


def test_non_finite_become_null(frame):
    df = frame("k STRING, x DOUBLE, n INT", [("a", float("inf"), 1), ("b", float("-inf"), 2), ("c", float("nan"), 3), ("d", 2.0, 4)])
    assert values(clean_numeric(df), "x", "n") == [(None, 1), (None, 2), (None, 3), (2.0, 4)]


def test_calendar_parts_and_business_days_match_pandas(frame, spark):
    days = pd.date_range("1969-12-20", "1970-02-10").append(pd.date_range("2020-12-20", "2021-01-15"))
    pairs = [(str(a.date()), str((a + pd.Timedelta(days=n)).date())) for a in days for n in (-3, -1, 0, 1, 5, 6, 13)]
    df = frame("a DATE, b DATE", pairs)
    out = df.select("a", "b", business_days("a", "b").alias("n"), *[v.alias(k) for k, v in calendar_parts("a").items()])
    for r in out.collect():
        a = pd.Timestamp(r.a)
        assert r.n == len(pd.bdate_range(a, pd.Timestamp(r.b)))
        assert (r.day_of_week, r.week_of_year, r.month, r.year) == (a.dayofweek, a.isocalendar().week, a.month, a.year)
    empty = spark.range(1).select(business_days(F.lit(None).cast("date"), F.lit("2024-01-01").cast("date")).alias("n"))
    assert empty.first().n is None


def test_day_accepts_only_whole_dates(frame):
    texts = ["2024011", "202401", "2024-1-1", "12345678", "20240230", "2024-02-29", " 20240229 ", "2024 1 1", "2024/01/01", "-", ""]
    got = {r.t: r.d for r in frame("t STRING", [(t,) for t in texts]).select("t", day("t").alias("d")).collect()}
    leap = dt.date(2024, 2, 29)
    assert got == {**dict.fromkeys(texts), "2024-02-29": leap, " 20240229 ": leap}
