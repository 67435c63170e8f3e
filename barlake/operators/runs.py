"""Run log and run outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def fold_run_log(records: DataFrame) -> DataFrame:
    """Current state per run from appended start and end records.

    A start record carries ``start_time``; an end record carries ``end_time`` and the
    outcome.  Runs without an end are still running.  If a run ended twice, the later
    end counts."""
    ended = F.col("end_time")
    outcome = ("status", "stocks_fetched", "stocks_cleaned", "error_msg", "quality_report")
    folded = records.groupBy("id").agg(
        F.min("run_date").alias("run_date"),
        F.min("start_time").alias("start_time"),
        F.max(ended).alias("end_time"),
        *[F.max_by(c, ended).alias(c) for c in outcome],
    )
    seconds = F.timestamp_diff("MICROSECOND", F.col("start_time"), F.col("end_time")) / F.lit(1e6)
    return folded.withColumns(
        {
            "status": F.coalesce("status", F.lit("running")),
            "stocks_fetched": F.coalesce("stocks_fetched", F.lit(0)),
            "stocks_cleaned": F.coalesce("stocks_cleaned", F.lit(0)),
            "duration_sec": seconds,
        }
    )


def run_tallies(outcomes: DataFrame, run_key: str) -> DataFrame:
    """Per run: instruments fetched, cleaned, failed, up to date, and rows written.

    ``outcomes`` has one row per run and instrument with ``outcome`` in ``cleaned``,
    ``failed``, ``up_to_date`` and the number of rows ``n_rows``."""
    is_ = lambda name: F.count_if(F.col("outcome") == name)
    return outcomes.groupBy(run_key).agg(
        is_("cleaned").alias("stocks_fetched"),
        is_("cleaned").alias("stocks_cleaned"),
        is_("failed").alias("stocks_failed"),
        is_("up_to_date").alias("stocks_up_to_date"),
        F.coalesce(F.sum(F.when(F.col("outcome") == "cleaned", F.col("n_rows"))), F.lit(0)).alias("kline_rows"),
    )


def run_status(report_status: Column | None = None) -> Column:
    """``failed`` if nothing at all worked, ``partial`` if something failed or the report
    is critical, else ``success``."""
    failures = F.col("stocks_failed") > 0
    nothing = (F.col("stocks_cleaned") == 0) & (F.col("stocks_up_to_date") == 0)
    trouble = failures if report_status is None else failures | F.coalesce(report_status == "critical", F.lit(False))
    return F.when(failures & nothing, "failed").when(trouble, "partial").otherwise("success")


def days_since_success(log: DataFrame, as_of: str, every_days: int = 7) -> DataFrame:
    """Last successful run and whether maintenance is due (never, or long enough ago)."""
    last = log.filter(F.col("status") == "success").agg(F.max("run_date").alias("last_success"))
    age = F.datediff(F.lit(as_of).cast("date"), F.col("last_success"))
    return last.withColumns(
        {"days_since": age, "maintenance_due": F.col("last_success").isNull() | (age >= every_days)}
    )
