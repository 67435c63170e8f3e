from __future__ import annotations

import json

import pandas as pd
import pytest

from barlake.operators import quality
from barlake.operators.quality import QualityRules

SECTION = (
    "ts_code STRING, trade_date DATE, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, vol DOUBLE, amount DOUBLE, "
    "pct_chg DOUBLE, adj_factor DOUBLE, flag_suspended BOOLEAN, flag_invalid_ohlc BOOLEAN"
)


def row(i, pct=1.0, high=2.0, amount=None, factor=None, suspended=False, invalid=False, day="2026-06-16"):
    return (f"{i:06d}.SZ", day, 1.0, high, 1.0, 1.0, 5.0, amount, pct, factor, suspended, invalid)


def test_known_missing_fields_are_silent(frame):
    cross = frame(SECTION, [row(1), row(2)])
    report = quality.quality_report(cross, cross, "2026-06-16", QualityRules(min_stock_count=1)).first()
    assert report.missing_rate == {} and report.anomalies == []
    assert (report.status, report.quality_score, report.extreme_stats) == ("normal", 100, None)


def test_full_report(frame):
    rows = [row(i, pct=20.0 if i < 3 else 150.0 if i == 3 else None if i == 4 else 1.0, high=None if i < 2 else 2.0,
                suspended=i < 4, invalid=i == 5) for i in range(20)]
    cross = frame(SECTION, rows)
    r = quality.quality_report(cross, cross, "2026-06-21").first()
    assert r.stock_count == 20 and r.missing_rate == {"high": 0.1}
    assert r.extreme_stats.asDict() == {"count": 3, "ratio": 0.1579, "min": 1.0, "max": 150.0}
    assert (r.suspension_count, r.suspension_ratio, r.invalid_ohlc_count) == (4, 0.2, 1)
    assert [a.message for a in r.anomalies] == [
        "有数据股票仅 20 只（< 1000）",
        "high 缺失率 10.0%（阈值 5%）",
        "pct_chg 极端值 3 个 (15.79%)",
        "停牌比例 20.0%（异常偏高）",
        "OHLC 关系非法 1 条",
        "数据延迟 5 天（最新 2026-06-16）",
    ]
    # 100 - 0.1*200 - 0.1579*500 - 6*5 - 0.2*200 is below zero
    assert (r.status, r.quality_score) == ("critical", 0)
    assert (r.date_range.min, r.date_range.max) == ("2026-06-16", "2026-06-16")


@pytest.mark.parametrize(
    ("n_null", "n_rows", "score", "status"), [(0, 40, 100, "normal"), (1, 40, 95, "normal"), (3, 40, 80, "warning"), (1, 30, 93, "normal")]
)
def test_score_is_cut_not_rounded(frame, n_null, n_rows, score, status):
    cross = frame(SECTION, [row(i, high=None if i < n_null else 2.0) for i in range(n_rows)])
    r = quality.quality_report(cross, cross, "2026-06-16", QualityRules(min_stock_count=10)).first()
    assert (r.quality_score, r.status) == (score, status)


def test_requested_day_without_rows(frame):
    cross = frame(SECTION, [row(1)])
    days = frame("trade_date DATE", [("2026-06-16",), ("2026-06-17",)])
    reports = {str(r.trade_date): r for r in quality.quality_report(cross, cross, "2026-06-17", QualityRules(min_stock_count=1), days).collect()}
    empty = reports["2026-06-17"]
    assert (empty.stock_count, empty.status, empty.quality_score) == (0, "critical", 0)
    assert [a.message for a in empty.anomalies] == ["交易日 2026-06-17 无可用数据"]
    assert empty.date_range is None and empty.missing_rate == {}


def test_top_fields_and_summary(frame):
    rows = [(f"{i}", "2026-06-16", None if i < 5 else 1.0, None if i < 7 else 1.0, None if i < 5 else 1.0, 1.0, None, 1.0, 1.0, 1.0, False, False) for i in range(10)]
    cross = frame(SECTION, rows)
    top = [(r.field, r.rate) for r in quality.missing_top(cross, 3).orderBy("place").collect()]
    assert top == [("vol", 1.0), ("high", 0.7), ("open", 0.5)]
    report = quality.quality_report(cross, cross, "2026-06-16", QualityRules(min_stock_count=1))
    assert quality.summary_lines(report).first().summary == "⚠️ 数据质量 | 2026-06-16 | 股票 10 | 得分 0 | 异常 4 项 | 状态 warning"


def test_json_documents(frame, tmp_path):
    cross = frame(SECTION, [row(1, pct=20.0, high=None), row(2, day="2026-06-17")])
    report = quality.quality_report(cross, cross, "2026-06-17", QualityRules(min_stock_count=1))
    quality.report_json(report).coalesce(1).write.json(f"{tmp_path}/out")
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part*"))
    docs = {x["date"]: x for x in map(json.loads, text.splitlines())}
    first = docs["2026-06-16"]
    assert first["missing_rate"] == {"high": 1.0} and first["extreme_stats"]["pct_chg"]["count"] == 1
    assert docs["2026-06-17"]["extreme_stats"] == {} and docs["2026-06-17"]["anomalies"] == []


def test_percent_text_rounds_like_the_binary_value(spark):
    shares = [k / 10000 for k in range(0, 10001, 7)]
    df = spark.createDataFrame([(s,) for s in shares], "s DOUBLE")
    from pyspark.sql import functions as F

    got = [r[0] for r in df.select(quality._percent(F.col("s"), 1)).collect()]
    assert got == [f"{s * 100:.1f}" for s in shares]
    assert pd.Series(got).notna().all()
