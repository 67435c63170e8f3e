"""Incremental runs: what to read again, and what the store looks like afterwards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barlake.operators.adjust import with_factors
from barlake.operators.lookups import MONTH, latest_date_by_stock
from barlake.operators.series import dedup_first, whole_series
from barlake.plans.cleaning import clean_bars
from barlake.schemas import BAR_KEY, DAILY_KLINE, PRICES
from barlake.storage.anchors import anchors_of, current_directory, save_anchors
from barlake.storage.tables import read_table, upsert, written_path

OVERLAP_DAYS = 10


def incremental_plan(
    pool: DataFrame, stored: DataFrame | None, base_start: str, end: str, overlap_days: int = OVERLAP_DAYS
) -> DataFrame:
    """(``ts_code``, ``start_date``) to read: everything since ``base_start`` for new
    instruments, a few days of overlap for known ones, nothing for those up to date.

    ``stored``: the bars, or one row per instrument with its ``latest_date``.  ``stored=None``
    is the full refresh: stored dates are ignored."""
    base = F.lit(base_start).cast("date")
    codes = pool.select("ts_code")
    if stored is None:
        return codes.withColumn("start_date", base)
    latest = stored.select("ts_code", "latest_date") if "latest_date" in stored.columns else latest_date_by_stock(stored)
    planned = codes.join(latest, "ts_code", "left")
    behind = F.col("latest_date").isNull() | (F.col("latest_date") < F.lit(end).cast("date"))
    start = F.coalesce(F.greatest(base, F.date_sub("latest_date", overlap_days)), base)
    return planned.filter(behind).select("ts_code", start.alias("start_date"))


def select_window(landed: DataFrame, plan: DataFrame, end: str, earliest: Column | None = None) -> DataFrame:
    """Landed bars the plan asks for, one per instrument and day (first arrival).

    The earliest day any instrument needs prunes the scan.  Copies are removed before the
    join by instrument, so that a much repeated bar is reduced where it is read."""
    earliest = plan.agg(F.min("start_date")).scalar() if earliest is None else earliest
    in_reach = landed.filter(F.col("trade_date").between(earliest, F.lit(end).cast("date")))
    window = dedup_first(in_reach).drop("ingest_seq").join(plan, "ts_code")
    return window.filter(F.col("trade_date") >= F.col("start_date")).drop("start_date")


def bars_at(bars: DataFrame, days: DataFrame) -> DataFrame:
    """Bars at one given day (``ts_code``, ``trade_date``) per instrument.

    The earliest of the days is computed first and skips older months, files and row groups."""
    earliest = days.agg(F.min("trade_date"), F.date_format(F.min("trade_date"), "yyyy-MM").alias("month"))
    recent = bars.filter(F.col("trade_date") >= earliest.select(F.col(earliest.columns[0])).scalar())
    if MONTH in bars.columns:
        recent = recent.filter(F.col(MONTH) >= earliest.select("month").scalar())
    return recent.join(days, list(BAR_KEY), "left_semi")


CONTEXT_COLUMNS = (*PRICES, "vol", "amount", "adj_factor")


def context_months(plan: DataFrame, directory: DataFrame) -> DataFrame:
    """(``ts_code``, ``start_date``, month): where an instrument's last bar before its window can be.

    That is the month of the window's start, which may hold bars on both sides of it, and the last month with
    bars before that one: of the months in the directory up to the start, the last two."""
    upto = F.filter("months", lambda m: m <= F.date_format("start_date", "yyyy-MM"))
    last_two = F.slice(upto, F.greatest(F.size(upto) - 1, F.lit(1)), 2)
    return plan.join(directory.select("ts_code", "months"), "ts_code").select("ts_code", "start_date", F.explode(last_two).alias(MONTH))


def context_rows(stored: DataFrame, plan: DataFrame, directory: DataFrame | None = None) -> DataFrame:
    """The last stored bar before each instrument's window.

    It gives the first window row a predecessor for its return and its fills, and is
    not written again.  With a directory of the bars only the months named there are opened: a short list, found from
    one row per instrument.  Without one, codes and days of all months are read to find the bar."""
    if directory is None or MONTH not in stored.columns:
        before = stored.select(*BAR_KEY).join(plan, "ts_code").filter(F.col("trade_date") < F.col("start_date"))
        days = before.groupBy("ts_code").agg(F.max("trade_date").alias("trade_date"))
        return bars_at(stored, days).select(*BAR_KEY, *CONTEXT_COLUMNS)
    wanted = context_months(plan, directory)
    months = [r[0] for r in wanted.select(MONTH).distinct().collect()]  # months, not data
    rows = stored.filter(F.col(MONTH).isin(months)).select(*BAR_KEY, MONTH, *CONTEXT_COLUMNS).join(wanted, ["ts_code", MONTH])
    last = rows.filter(F.col("trade_date") < F.col("start_date")).groupBy("ts_code").agg(
        *[F.max_by(c, "trade_date").alias(c) for c in CONTEXT_COLUMNS], F.max("trade_date").alias("trade_date")
    )
    return last.select(*BAR_KEY, *CONTEXT_COLUMNS)


def late_first_factors(stored: DataFrame, codes: DataFrame) -> DataFrame:
    """Stored bars before the first factor of the given instruments, with that factor.

    An instrument whose first factor came after its first bars needs this once in its life."""
    scope = stored.select(*BAR_KEY, "adj_factor").join(codes.select("ts_code"), "ts_code", "left_semi")
    first = F.first("adj_factor", ignorenulls=True).over(whole_series())
    filled = scope.withColumn("first_factor", first).filter(F.col("adj_factor").isNull() & F.col("first_factor").isNotNull())
    return filled.select(*BAR_KEY, F.col("first_factor").alias("adj_factor"))


def incremental_batch(
    stored: DataFrame,
    landed: DataFrame,
    plan: DataFrame,
    factors: DataFrame,
    open_days: DataFrame,
    end: str,
    max_daily_pct: float = 15.0,
    directory: DataFrame | None = None,
) -> DataFrame:
    """Clean rows of the read-again window, ready to be upserted.

    ``landed`` carries ``ingest_seq`` and the bar columns."""
    window = select_window(landed, plan, end)
    context = context_rows(stored, plan, directory)
    # the context bar's own factor joins the feed, so fills continue from it
    factor_rows = factors.select(*BAR_KEY, "adj_factor").join(
        context.select(*BAR_KEY), list(BAR_KEY), "left_anti"
    ).unionByName(context.select(*BAR_KEY, "adj_factor"))
    series = window.unionByName(context.drop("adj_factor"), allowMissingColumns=True)
    cleaned = with_factors(clean_bars(series, open_days, max_daily_pct, order=None), factor_rows)
    fresh = cleaned.join(plan, "ts_code").filter(F.col("trade_date") >= F.col("start_date"))
    return fresh.drop("start_date")


def run_incremental(
    spark: SparkSession,
    path: str,
    landed: DataFrame,
    pool: DataFrame,
    factors: DataFrame,
    open_days: DataFrame,
    base_start: str,
    end: str,
    max_daily_pct: float = 15.0,
) -> int:
    """Read the window again, clean, upsert; then note the planned instruments' new anchors.

    Returns the number of bars written from the window.  Adjusted prices are derived on
    reading (:mod:`barlake.storage.anchors`), so a new factor rewrites no older month.  The plan
    (a row per instrument) is kept in a table of its own, because the bars are rewritten.

    The anchors come last and decide what is planned: a run that broke off anywhere is made
    good by the next one, which plans the same instruments again."""
    known = current_directory(spark, path)
    plan = _kept(spark, incremental_plan(pool, known, base_start, end), plan_path(path))
    stored = read_table(spark, path, DAILY_KLINE)
    batch = incremental_batch(stored, landed, plan, factors, open_days, end, max_daily_pct, known)
    written = upsert(spark, path, DAILY_KLINE, batch, unique=True, count_by="ts_code")

    moved = _kept(spark, window_anchors(read_table(spark, path, DAILY_KLINE), plan), f"{path.rstrip('/')}__moved")
    had_none = known.filter(F.col("last_factor").isNull()).select("ts_code")
    late = moved.filter(F.col("last_factor").isNotNull()).join(had_none, "ts_code", "left_semi")
    if not late.isEmpty():
        upsert(spark, path, DAILY_KLINE, late_first_factors(read_table(spark, path, DAILY_KLINE), late), unique=True)
    save_anchors(spark, path, updated_anchors(known, moved))
    return written


def window_anchors(stored: DataFrame, plan: DataFrame) -> DataFrame:
    """Latest day and last factor within each planned instrument's window; older months are not opened."""
    first = plan.agg(F.min("start_date"), F.date_format(F.min("start_date"), "yyyy-MM").alias("month"))
    recent = stored.filter(F.col("trade_date") >= first.select(F.col(first.columns[0])).scalar())
    if MONTH in stored.columns:
        recent = recent.filter(F.col(MONTH) >= first.select("month").scalar())
    rows = recent.select(*BAR_KEY, "adj_factor").join(plan, "ts_code").filter(F.col("trade_date") >= F.col("start_date"))
    return anchors_of(rows)


def updated_anchors(known: DataFrame, moved: DataFrame) -> DataFrame:
    """``known`` with the rows of ``moved``; what the window does not tell stays."""
    new = moved.toDF(*["ts_code" if c == "ts_code" else f"new_{c}" for c in moved.columns])
    none = F.array().cast("array<string>")
    months = F.array_union(F.coalesce("months", none), F.coalesce("new_months", none))
    return known.join(new, "ts_code", "full_outer").select(
        "ts_code",
        F.least("first_date", "new_first_date").alias("first_date"),
        F.greatest("latest_date", "new_latest_date").alias("latest_date"),
        F.coalesce("new_last_factor", "last_factor").alias("last_factor"),
        F.array_sort(months).alias("months"),
    )


def plan_path(path: str) -> str:
    """What the last run into the bars at ``path`` planned to read."""
    return f"{path.rstrip('/')}__plan"


def run_rows(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Of the last run into the bars at ``path``: its plan, and the rows it wrote per instrument."""
    plan = spark.read.schema("ts_code STRING, start_date DATE").parquet(plan_path(path))
    return plan, spark.read.schema("ts_code STRING, n_rows LONG").parquet(written_path(path))


def _kept(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def run_full_refresh(
    spark: SparkSession,
    path: str,
    landed: DataFrame,
    pool: DataFrame,
    factors: DataFrame,
    open_days: DataFrame,
    base_start: str,
    end: str,
    max_daily_pct: float = 15.0,
) -> int:
    """Read everything since ``base_start`` again, whatever is stored, and upsert it.

    Bars stored from before ``base_start`` share the new anchors."""
    known = current_directory(spark, path)
    plan = _kept(spark, incremental_plan(pool, None, base_start, end), plan_path(path))
    window = select_window(landed, plan, end, earliest=F.lit(base_start).cast("date"))
    batch = with_factors(clean_bars(window, open_days, max_daily_pct, order=None), factors)
    written = upsert(spark, path, DAILY_KLINE, batch, unique=True, count_by="ts_code")
    save_anchors(spark, path, updated_anchors(known, window_anchors(read_table(spark, path, DAILY_KLINE), plan)))
    return written
