"""Daily data-quality reports over cross-sections.

All numbers of all days come from one aggregation with map-side combine; anomalies,
status and score are projections of its rows (one row per day)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from barlake.functions.columns import true_only
from barlake.operators.lookups import with_basics

# Fields whose share of NULLs is reported, in report order.
BAR_FIELDS = ("open", "high", "low", "close", "vol", "amount", "adj_factor", "flag_suspended")
BASIC_FIELDS = ("pe", "pb", "turnover_rate")

# Bounds of an extreme daily move in percent, low end included.
EXTREME_FROM, EXTREME_BELOW = 15, 100

# Report texts.
TEXT_FEW_STOCKS = "有数据股票仅 %d 只（< %d）"
TEXT_MISSING = "%s 缺失率 %s%%（阈值 %s%%）"
TEXT_EXTREME = "%s 极端值 %d 个 (%s%%)"
TEXT_SUSPENDED = "停牌比例 %s%%（异常偏高）"
TEXT_INVALID = "OHLC 关系非法 %d 条"
TEXT_LAG = "数据延迟 %d 天（最新 %s）"
TEXT_NO_DATA = "交易日 %s 无可用数据"
TEXT_SUMMARY = "%s 数据质量 | %s | 股票 %d | 得分 %d | 异常 %d 项 | 状态 %s"
STATUS_SIGN = {"normal": "✅", "warning": "⚠️", "critical": "🚨"}


@dataclass(frozen=True)
class QualityRules:
    """Thresholds of the report."""

    min_stock_count: int = 1000
    missing_ratio: float = 0.05
    extreme_ratio: float = 0.02
    suspension_ratio: float = 0.15
    max_lag_days: int = 3
    known_missing: tuple[str, ...] = ("amount", "adj_factor")
    with_basics: bool = False

    def fields(self, columns: list[str]) -> list[str]:
        wanted = BAR_FIELDS + (BASIC_FIELDS if self.with_basics else ())
        return [c for c in wanted if c in columns and c not in self.known_missing]


def day_statistics(cross: DataFrame, rules: QualityRules = QualityRules(), counted: Column | None = None) -> DataFrame:
    """Counts per day: rows, NULLs per field, extreme moves, suspensions, invalid prices.

    ``counted`` tells which rows count; a day of which none does is there with no rows."""
    fields = rules.fields(cross.columns)
    every = F.lit(True) if counted is None else true_only(counted)
    move = F.when(every, F.col("pct_chg"))
    extreme = (F.abs(move) >= EXTREME_FROM) & (F.abs(move) < EXTREME_BELOW)
    counts = cross.groupBy("trade_date").agg(
        F.count_if(every).alias("stock_count"),
        *[F.count_if(every & F.col(c).isNull()).alias(f"null_{c}") for c in fields],
        F.count_if(true_only(extreme)).alias("extreme_count"),
        F.count(move).alias("move_count"),
        F.min(move).alias("move_min"),
        F.max(move).alias("move_max"),
        F.count_if(every & true_only(F.col("flag_suspended"))).alias("suspension_count"),
        F.count_if(every & true_only(F.col("flag_invalid_ohlc"))).alias("invalid_ohlc_count"),
    )
    stocks = F.nullif("stock_count", F.lit(0))
    share = {f"rate_{c}": F.round(F.col(f"null_{c}") / stocks, 4) for c in fields}
    return counts.withColumns(
        {
            **{name: F.when(F.col(name.replace("rate_", "null_", 1)) > 0, value) for name, value in share.items()},
            "suspension_ratio": F.round(F.col("suspension_count") / stocks, 4),
            "extreme_ratio": F.when(
                F.col("extreme_count") > 0, F.round(F.col("extreme_count") / F.col("move_count"), 4)
            ),
        }
    )


def _missing_entries(fields: list[str]) -> Column:
    """Array of (position, field, rate) for the fields that have NULLs."""
    entries = [
        F.when(
            F.col(f"rate_{c}").isNotNull(),
            F.struct(F.lit(i).alias("position"), F.lit(c).alias("field"), F.col(f"rate_{c}").alias("rate")),
        )
        for i, c in enumerate(fields)
    ]
    return F.array_compact(F.array(*entries))


def missing_rates(cross: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """One row per day and field with NULLs: share rounded to 4 places."""
    stats = day_statistics(cross, rules)
    entries = _missing_entries(rules.fields(cross.columns))
    return stats.select("trade_date", F.inline(entries))


def missing_top(cross: DataFrame, n: int = 5, rules: QualityRules = QualityRules()) -> DataFrame:
    """The n fields with the highest share per day; report order decides ties.

    A day has at most as many rows here as there are report fields."""
    place = F.row_number().over(Window.partitionBy("trade_date").orderBy(F.desc("rate"), "position"))
    return missing_rates(cross, rules).withColumn("place", place).filter(F.col("place") <= n).drop("position")


def extreme_stats(cross: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Days with extreme moves: count, ratio to known moves, smallest and largest move."""
    return (
        day_statistics(cross, rules)
        .filter(F.col("extreme_count") > 0)
        .select(
            "trade_date",
            "extreme_count",
            "extreme_ratio",
            F.round("move_min", 2).alias("move_min"),
            F.round("move_max", 2).alias("move_max"),
        )
    )


def suspension_stats(cross: DataFrame) -> DataFrame:
    return day_statistics(cross).select(
        "trade_date", "stock_count", "suspension_count", "suspension_ratio", "invalid_ohlc_count"
    )


def _percent(share: Column, digits: int) -> Column:
    # percentages stay below the first thousands separator except for absurd input
    return F.replace(F.format_number(share * 100, digits), F.lit(","), F.lit(""))


def _anomaly(rule: str, severity: str, field: Column, value: Column, message: Column) -> Column:
    return F.struct(
        F.lit(rule).alias("rule"),
        F.lit(severity).alias("severity"),
        field.alias("field"),
        value.cast("double").alias("value"),
        message.alias("message"),
    )


def anomalies(fields: list[str], as_of: str, rules: QualityRules) -> Column:
    """Array of anomalies of a day, in report order."""
    none = F.lit(None).cast("string")
    lag = F.datediff(F.lit(as_of).cast("date"), F.col("trade_date"))
    found = [
        F.when(
            F.col("stock_count") < rules.min_stock_count,
            _anomaly(
                "few_stocks", "critical", none, F.col("stock_count"),
                F.format_string(TEXT_FEW_STOCKS, F.col("stock_count"), F.lit(rules.min_stock_count)),
            ),
        )
    ]
    for c in fields:
        rate = F.col(f"rate_{c}")
        text = F.format_string(TEXT_MISSING, F.lit(c), _percent(rate, 1), F.lit(f"{rules.missing_ratio * 100:.0f}"))
        found.append(
            F.when(rate > rules.missing_ratio, _anomaly("missing", "warning", F.lit(c), rate, text))
        )
    extreme = F.col("extreme_ratio")
    found.append(
        F.when(
            extreme > rules.extreme_ratio,
            _anomaly(
                "extreme", "warning", F.lit("pct_chg"), extreme,
                F.format_string(TEXT_EXTREME, F.lit("pct_chg"), F.col("extreme_count"), _percent(extreme, 2)),
            ),
        )
    )
    halted = F.col("suspension_ratio")
    found.append(
        F.when(
            halted > rules.suspension_ratio,
            _anomaly("suspended", "warning", none, halted, F.format_string(TEXT_SUSPENDED, _percent(halted, 1))),
        )
    )
    invalid = F.col("invalid_ohlc_count")
    found.append(
        F.when(invalid > 0, _anomaly("invalid_ohlc", "warning", none, invalid, F.format_string(TEXT_INVALID, invalid)))
    )
    found.append(
        F.when(
            lag > rules.max_lag_days,
            _anomaly(
                "lag", "warning", none, lag,
                F.format_string(TEXT_LAG, lag, F.col("trade_date").cast("string")),
            ),
        )
    )
    return F.array_compact(F.array(*found))


def status() -> Column:
    """``critical`` if any anomaly is, ``warning`` if there are others, else ``normal``."""
    return (
        F.when(F.exists("anomalies", lambda a: a["severity"] == "critical"), "critical")
        .when(F.size("anomalies") > 0, "warning")
        .otherwise("normal")
    )


def quality_score(fields: list[str]) -> Column:
    """100 minus penalties, cut to an integer and kept within 0..100.

    Per percent: 2 for missing values and suspensions, 5 for extreme moves; 5 per anomaly."""
    score = F.lit(100.0)
    for c in fields:
        score = score - F.coalesce(F.col(f"rate_{c}"), F.lit(0.0)) * 100 * 2
    score = score - F.coalesce(F.col("extreme_ratio"), F.lit(0.0)) * 100 * 5
    score = score - F.size("anomalies") * 5
    score = score - F.col("suspension_ratio") * 100 * 2
    return F.greatest(F.lit(0), F.least(F.lit(100), score.cast("int")))


def quality_report(
    cross: DataFrame,
    bars: DataFrame,
    as_of: str,
    rules: QualityRules = QualityRules(),
    days: DataFrame | None = None,
) -> DataFrame:
    """One report row per day of ``cross``, or per requested day.

    ``bars`` is the whole store; its first and last day are part of every report.  Of the store's
    directory (a row per instrument with ``first_date`` and ``latest_date``) they are as well.  A
    requested day without rows is critical with score 0."""
    first, last = ("first_date", "latest_date") if "first_date" in bars.columns else ("trade_date", "trade_date")
    span = bars.agg(F.min(first).cast("string").alias("min"), F.max(last).cast("string").alias("max"))
    stats = day_statistics(cross, rules).withColumn("date_range", span.select(F.struct("min", "max")).scalar())
    return _reports(stats, rules.fields(cross.columns), as_of, rules, days)


def store_report(
    bars: DataFrame,
    basics: DataFrame,
    as_of: str,
    rules: QualityRules = QualityRules(),
    days: DataFrame | None = None,
) -> DataFrame:
    """:func:`quality_report` of all days of a store in one pass over its bars.

    The bars are joined with their fundamentals once and aggregated once, also those that do not count,
    since they may be the first or last of the store; its span is taken from the rows of the days."""
    joined = with_basics(bars, basics)
    every_day = Window.orderBy("trade_date").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    span = F.struct(
        F.first("trade_date").over(every_day).cast("string").alias("min"), F.last("trade_date").over(every_day).cast("string").alias("max")
    )
    stats = day_statistics(joined, rules, F.col("close") > 0).withColumn("date_range", span).filter("stock_count > 0")
    return _reports(stats, rules.fields(joined.columns), as_of, rules, days)


def _reports(stats: DataFrame, fields: list[str], as_of: str, rules: QualityRules, days: DataFrame | None) -> DataFrame:
    """Reports from the counts and the store's span, one row per day."""
    if days is not None:
        stats = days.select("trade_date").distinct().join(stats, "trade_date", "left")
    empty = F.col("stock_count").isNull()
    no_data = F.array(
        _anomaly(
            "no_data", "critical", F.lit(None).cast("string"), F.lit(0),
            F.format_string(TEXT_NO_DATA, F.col("trade_date").cast("string")),
        )
    )
    judged = (
        stats.withColumn("anomalies", F.when(empty, no_data).otherwise(anomalies(fields, as_of, rules)))
        .withColumn("status", status())
        .withColumn("quality_score", F.when(empty, 0).otherwise(quality_score(fields)))
    )
    missing = F.map_from_entries(
        F.transform(_missing_entries(fields), lambda e: F.struct(e["field"], e["rate"]))
    )
    extreme = F.struct(
        F.col("extreme_count").alias("count"),
        F.col("extreme_ratio").alias("ratio"),
        F.round("move_min", 2).alias("min"),
        F.round("move_max", 2).alias("max"),
    )
    return judged.select(
        "trade_date",
        F.coalesce("stock_count", F.lit(0)).alias("stock_count"),
        missing.alias("missing_rate"),
        F.when(F.col("extreme_count") > 0, extreme).alias("extreme_stats"),
        F.coalesce("suspension_count", F.lit(0)).alias("suspension_count"),
        F.coalesce("suspension_ratio", F.lit(0.0)).alias("suspension_ratio"),
        F.coalesce("invalid_ohlc_count", F.lit(0)).alias("invalid_ohlc_count"),
        F.when(~empty, F.col("date_range")).alias("date_range"),
        "anomalies",
        "status",
        "quality_score",
    )


def anomaly_rows(report: DataFrame) -> DataFrame:
    """One row per anomaly."""
    return report.select("trade_date", F.inline("anomalies"))


def summary_lines(report: DataFrame) -> DataFrame:
    """One line of text per report, for message titles."""
    sign = F.create_map(*[F.lit(part) for item in STATUS_SIGN.items() for part in item])
    line = F.format_string(
        TEXT_SUMMARY,
        F.coalesce(F.try_element_at(sign, F.col("status")), F.lit("❓")),
        F.col("trade_date").cast("string"),
        F.col("stock_count"),
        F.col("quality_score"),
        F.size("anomalies"),
        F.col("status"),
    )
    return report.select("trade_date", line.alias("summary"))


def report_json(report: DataFrame) -> DataFrame:
    """Report rows in the layout of the JSON files, one document per day."""
    return report.select(
        F.col("trade_date").cast("string").alias("date"),
        "stock_count",
        "missing_rate",
        F.when(F.col("extreme_stats").isNotNull(), F.create_map(F.lit("pct_chg"), F.col("extreme_stats")))
        .otherwise(F.create_map().cast(_EXTREME_MAP))
        .alias("extreme_stats"),
        "suspension_count",
        "suspension_ratio",
        "invalid_ohlc_count",
        "date_range",
        F.transform("anomalies", lambda a: a["message"]).alias("anomalies"),
        "status",
        "quality_score",
    )


_EXTREME_MAP = "map<string,struct<count:bigint,ratio:double,min:double,max:double>>"
