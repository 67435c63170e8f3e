"""One daily run over landed feeds: store, clean, report, audit, log."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from barlake.operators.lookups import cross_section
from barlake.operators.quality import QualityRules, quality_report, report_json
from barlake.operators.runs import run_status, run_tallies
from barlake.operators.universe import stock_pool
from barlake.plans.audit import sampled_source_audit
from barlake.plans.incremental import incremental_plan, run_full_refresh, run_incremental, run_rows
from barlake.sources.routing import fill_windows
from barlake.storage import upserts
from barlake.storage.anchors import current_anchors, current_directory
from barlake.storage.store import init_store, open_store, table_path


# Error text of an instrument without landed rows, and how many the log's message
# names.  The outcome of every instrument is in the table of outcomes.
TEXT_NO_ROWS = "数据源返回空数据"
MAX_ERRORS = 10


def outcomes_path(root: str, run_id: int) -> str:
    """Table of (``ts_code``, ``outcome``, ``n_rows``) of one run, a row per pool instrument."""
    return f"{root.rstrip('/')}/run_outcomes/run_id={run_id}"


@dataclass(frozen=True)
class Feeds:
    """Landed and normalised inputs of a run; optional ones may be missing."""

    calendar: DataFrame
    instruments: DataFrame
    bars: DataFrame | dict[str, DataFrame]  # with ingest_seq; by source, the preferred one first
    factors: DataFrame
    name_history: DataFrame | None = None
    basics: DataFrame | None = None
    financials: DataFrame | None = None
    second_source: DataFrame | None = None


@dataclass(frozen=True)
class Settings:
    base_start: str = "2026-01-01"
    include_exchanges: tuple[str, ...] = ("SZSE", "SSE")
    exclude_ipo_within_days: int = 60
    max_daily_pct: float = 15.0
    rules: QualityRules = field(default_factory=QualityRules)
    audit_sample: int | None = None  # None: the whole pool
    history_on_full_refresh_only: bool = True
    audit_lookback_days: int = 5


def daily_run(
    spark: SparkSession,
    root: str,
    feeds: Feeds,
    run_id: int,
    day: str,
    started_at: str,
    ended_at: str | None = None,
    full_refresh: bool = False,
    settings: Settings = Settings(),
) -> str:
    """Run all steps for ``day``; returns ``success``, ``partial`` or ``failed``.

    Name history is taken in on a full refresh only, unless the settings say otherwise.  Times are arguments, so that a run
    can be repeated; without ``ended_at`` the clock gives the end.  An exception is logged
    as a failed run and raised again."""
    init_store(spark, root)
    log = table_path(root, "pipeline_log")
    run = spark.range(1).select(F.lit(run_id).cast("long").alias("id"), F.lit(day).cast("date").alias("run_date"))
    upserts.append_run_records(log, run.withColumn("start_time", F.lit(started_at).cast("timestamp")))
    ended = F.lit(ended_at).cast("timestamp") if ended_at else F.current_timestamp()
    try:
        outcome = _steps(spark, root, feeds, run, run_id, day, started_at, full_refresh, settings)
    except Exception as error:
        failure = {"status": F.lit("failed"), "error_msg": F.lit(str(error)), "end_time": ended}
        upserts.append_run_records(log, run.withColumns(failure))
        raise
    upserts.append_run_records(log, outcome.withColumn("end_time", ended))
    logged = open_store(spark, root)["pipeline_log"]
    return logged.filter(F.col("id") == run_id).select("status").first()[0]


def _steps(
    spark: SparkSession,
    root: str,
    feeds: Feeds,
    run: DataFrame,
    run_id: int,
    day: str,
    started_at: str,
    full_refresh: bool,
    settings: Settings,
) -> DataFrame:
    """All steps; gives the end record of the run, without its time."""
    path = lambda name: table_path(root, name)
    upserts.upsert_calendar(spark, path("trade_calendar"), feeds.calendar)
    upserts.refresh_previous_days(spark, path("trade_calendar"))
    upserts.upsert_instruments(spark, path("stock_list"), feeds.instruments, started_at)
    if feeds.name_history is not None and (full_refresh or not settings.history_on_full_refresh_only):
        upserts.upsert_name_history(spark, path("stock_name_history"), feeds.name_history)
    if feeds.basics is not None:
        upserts.upsert_daily_basic(spark, path("daily_basic"), feeds.basics)
    if feeds.financials is not None:
        upserts.upsert_financials(spark, path("financial_indicators"), feeds.financials)

    store = open_store(spark, root)
    pool = stock_pool(store["stock_list"], day, list(settings.include_exchanges), True, settings.exclude_ipo_within_days)
    open_days = store["trade_calendar"].filter("is_open = 1").select("trade_date")
    outcomes = outcomes_path(root, run_id)
    stored = None if full_refresh else current_anchors(spark, path("daily_kline"))
    plan = incremental_plan(pool, stored, settings.base_start, day)
    landed = _routed(spark, path("daily_kline"), feeds.bars, plan, day)
    step = run_full_refresh if full_refresh else run_incremental
    step(
        spark, path("daily_kline"), landed, pool, feeds.factors, open_days,
        settings.base_start, day, settings.max_daily_pct,
    )
    _outcomes(pool, *run_rows(spark, path("daily_kline"))).write.mode("overwrite").parquet(outcomes)

    store = open_store(spark, root)
    bars = store["daily_kline"]
    section = cross_section(bars, store["daily_basic"], day)
    asked = spark.range(1).select(F.lit(day).cast("date").alias("trade_date"))
    report = quality_report(section, current_directory(spark, path("daily_kline")), day, settings.rules, asked)
    upserts.save_reports(f"{root.rstrip('/')}/quality_reports", report)
    if feeds.second_source is not None:
        found = sampled_source_audit(
            pool, landed, feeds.second_source, day, day, settings.audit_sample, settings.audit_lookback_days
        )
        upserts.upsert_source_audit(spark, path("data_source_audit"), found)

    results = spark.read.parquet(outcomes)
    tallies = run_tallies(results.withColumn("id", F.lit(run_id).cast("long")), "id")
    document = report_json(report).select(
        F.lit(run_id).cast("long").alias("id"), F.col("status").alias("report_status"),
        F.to_json(F.struct("*")).alias("quality_report"),
    )
    message = F.concat("ts_code", F.lit(f": {TEXT_NO_ROWS}"))
    every = results.filter("outcome = 'failed'")
    failed = every.orderBy("ts_code").limit(MAX_ERRORS).select(message.alias("message"))
    errors = failed.agg(F.array_join(F.array_sort(F.collect_list("message")), "; ").alias("joined"))
    beyond = F.when(F.count("*") > MAX_ERRORS, F.concat(F.lit("; "), F.count("*"), F.lit(" failed")))
    more = every.agg(F.coalesce(beyond, F.lit("")).alias("more"))
    return (
        run.join(tallies, "id", "left")
        .join(document, "id", "left")
        .fillna(0, ["stocks_fetched", "stocks_cleaned", "stocks_failed", "stocks_up_to_date"])
        .withColumn("status", run_status(F.col("report_status")))
        .withColumn("error_msg", F.nullif(F.concat(errors.scalar(), more.scalar()), F.lit("")))
    )


def _routed(spark: SparkSession, path: str, bars: DataFrame | dict[str, DataFrame], plan: DataFrame, day: str) -> DataFrame:
    """The landed bars; of several sources those that each instrument's window takes, as a table."""
    if isinstance(bars, DataFrame):
        return bars

    def kept(rows: DataFrame, name: str) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{path}__{name}")
        return spark.read.schema(rows.schema).parquet(f"{path}__{name}")

    requests = kept(plan.withColumn("end_date", F.lit(day).cast("date")), "requests")
    return kept(fill_windows(requests, bars, lambda rows, name: kept(rows, f"open_{name}")).drop("source"), "routed")


def _outcomes(pool: DataFrame, plan: DataFrame, written: DataFrame) -> DataFrame:
    """Per pool instrument: ``cleaned`` with the rows the run stored, ``failed`` if it should have
    stored some, ``up_to_date`` if nothing was asked for."""
    due = plan.select("ts_code", F.lit(True).alias("due"))
    return (
        pool.join(due, "ts_code", "left")
        .join(written, "ts_code", "left")
        .select(
            "ts_code",
            F.when(F.col("due").isNull(), "up_to_date").when(F.col("n_rows") > 0, "cleaned").otherwise("failed").alias("outcome"),
            F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        )
    )
