"""One Spark query per operator, over the whole of the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barlake.functions.codes import exchange_of, suffix_of, symbol_of, ts_code_of, zero_pad
from barlake.functions.columns import clean_numeric as null_non_finite
from barlake.functions.columns import number
from barlake.functions.dates import business_days, calendar_parts, request_day
from barlake.operators import adjust, asof, audit, calendar, lookups, outliers, quality, runs, series, universe
from barlake.plans.audit import sampled_source_audit
from barlake.plans.cleaning import clean_and_adjust, clean_bars
from barlake.plans.daily import Feeds, Settings, daily_run, outcomes_path
from barlake.plans.incremental import incremental_plan, run_full_refresh, run_incremental
from barlake.schemas import (
    BAR_KEY,
    DAILY_BASIC,
    DAILY_KLINE,
    DATA_SOURCE_AUDIT,
    FINANCIAL_INDICATORS,
    FLAGS,
    PIPELINE_LOG,
    PRICES,
    QFQ_PRICES,
    STOCK_LIST,
    STOCK_NAME_HISTORY,
    TRADE_CALENDAR,
    TableSpec,
)
from barlake.session import scratch_path, tune
from barlake.sources import frames, instruments as instrument_lists, payloads, routing
from barlake.storage import tables, upserts
from barlake.storage.anchors import read_adjusted
from barlake.storage.store import init_store, open_store, table_path
from barlake.streaming.ingest import stream_upsert_bars
from verification import domain as d

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# thresholds of the quality queries: markets here are smaller than a real one
RULES = quality.QualityRules(min_stock_count=100, known_missing=("amount",))
WIDE_MOVE = 300.0


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tune(spark), sf_dir)

    # a trailing underscore tells a query from the library function of the same name
    QUERIES[fn.__name__.rstrip("_")] = run
    return run


def r6(column: Column | str) -> Column:
    """Logarithms, means, deviations and interpolated quantiles are compared at six places:
    engines may differ in their last bit.  Sums, products and quotients are compared as they are."""
    return F.round(column, 6)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: r6(n) for n in names})


def dated(value: str) -> Column:
    return F.lit(value).cast("date")


def text_date(column: str) -> Column:
    return F.date_format(column, "yyyyMMdd")


def landed_path(rows: DataFrame, name: str) -> str:
    """Land a frame of lines as text files."""
    path = scratch_path(rows.sparkSession, name)
    rows.write.text(path)
    return path


def stored_table(spark: SparkSession, spec: TableSpec, rows: DataFrame) -> str:
    """A table holding ``rows``; columns they lack are NULL, flags false."""
    path = scratch_path(spark, spec.name)
    missing = {c: F.lit(spec.insert_defaults.get(c)).cast(spec.schema[c].dataType) for c in spec.columns if c not in rows.columns}
    tables.init_table(spark, path, spec)
    tables.write_partitions(rows.withColumns(missing), path, spec)
    return path


def table_state(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    return tables.read_table(spark, path, spec).select(*spec.columns)


# --- sources ------------------------------------------------------------------------------


@query
def src_tencent_bars(spark, sf_dir):
    text = lambda c: F.col(c).cast("string")
    item = F.array(text("trade_date"), text("open"), text("close"), text("high"), text("low"), text("vol"))
    market = F.lower(suffix_of("symbol"))
    body = F.to_json(
        F.struct(
            F.lit(0).alias("code"),
            F.create_map(F.concat(market, F.col("symbol")), F.struct(F.col("items").alias("day"))).alias("data"),
        )
    )
    one_response = d.with_symbol(d.bars(spark, sf_dir)).groupBy("symbol").agg(F.collect_list(item).alias("items"))
    path = landed_path(one_response.select(F.concat_ws("\t", "symbol", body)), "nested")
    bars = payloads.nested_array_bars(payloads.read_payloads(spark, path), "2024-01-05", "2024-01-25")
    return bars.select(*BAR_KEY, *PRICES, "vol", "amount", "pct_chg", "raw_close", "flag_suspended")


@query
def src_eastmoney_bars(spark, sf_dir):
    cell = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    bars = d.with_symbol(d.bars(spark, sf_dir))
    change = F.round(F.col("close") - F.col("open"), 2)
    cells = [F.col(c) for c in ("trade_date", "open", "close", "high", "low", "vol", "amount")]
    line = F.concat_ws(",", *[cell(c) for c in (*cells, F.lit(0), change, F.lit(0), F.lit(0))])
    body = F.to_json(F.struct(F.lit(0).alias("rc"), F.struct(F.col("klines")).alias("data")))
    one_response = bars.groupBy("symbol").agg(F.collect_list(line).alias("klines"))
    path = landed_path(one_response.select(F.concat_ws("\t", "symbol", body)), "csvlines")
    parsed = payloads.csv_line_bars(payloads.read_payloads(spark, path))
    return parsed.select(*BAR_KEY, *PRICES, "vol", "amount", "pct_chg", "adj_factor", "raw_open", "price_type")


@query
def src_sina_bars(spark, sf_dir):
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("--"))
    entry = F.struct(text("trade_date").alias("day"), *[text(p).alias(p) for p in PRICES], text("vol").alias("volume"))
    one_response = d.with_symbol(d.bars(spark, sf_dir)).groupBy("symbol").agg(F.collect_list(entry).alias("rows"))
    path = landed_path(one_response.select(F.concat_ws("\t", "symbol", F.to_json("rows"))), "objects")
    parsed = payloads.object_array_bars(payloads.read_payloads(spark, path), "2024-01-05", "2024-01-25")
    return parsed.select(*BAR_KEY, *PRICES, "vol", "amount")


@query
def src_localized_bars(spark, sf_dir):
    header = {v: k for k, v in frames.LOCALISED_HEADERS.items()}
    bars = d.with_symbol(d.bars(spark, sf_dir))
    columns = ["trade_date", *PRICES, "vol", "amount"]
    path = scratch_path(spark, "localized")
    bars.select("symbol", *[F.col(c).alias(header[c]) for c in columns]).write.csv(path, header=True)
    return frames.read_localized_bars(spark, path).select(*BAR_KEY, *PRICES, "vol", "amount")


@query
def src_dated_string_bars(spark, sf_dir):
    feed = d.bars(spark, sf_dir).withColumns(
        {"trade_date": text_date("trade_date"), "amount": (F.col("amount") / 1000).cast("string")}
    )
    parsed = frames.dated_string_bars(feed)
    return parsed.withColumn("amount", F.round("amount", 2)).select(*BAR_KEY, *PRICES, "vol", "amount")


@query
def src_adj_factor(spark, sf_dir):
    feed = d.factors(spark, sf_dir).withColumn("trade_date", text_date("trade_date"))
    return frames.adjustment_factors(feed)


@query
def src_calendar(spark, sf_dir):
    feed = d.order_calendar(spark, sf_dir).select(text_date("trade_date").alias("cal_date"), F.col("is_open").cast("string").alias("is_open"))
    return frames.calendar_feed(feed).select("trade_date", "is_open")


@query
def calendar_complete(spark, sf_dir):
    feed = d.order_calendar(spark, sf_dir).filter("is_open = 1").select("trade_date")
    year = F.year("trade_date")
    years = feed.select(F.explode(F.array(year, year + 1)).alias("year"))
    return calendar.complete_calendar(feed, years)


def _basic_feed(spark, sf_dir):
    pe, turnover = F.col("pe"), F.col("turnover_rate")
    return d.basics(spark, sf_dir).withColumns(
        {"volume_ratio": turnover * 2, "circ_mv": r6(pe * 1000), "total_mv": r6(pe * 2000)}
    )


@query
def src_daily_basic(spark, sf_dir):
    return frames.daily_basics(_basic_feed(spark, sf_dir).withColumn("trade_date", text_date("trade_date")))


@query
def src_financials(spark, sf_dir):
    feed = d.reports(spark, sf_dir).withColumns(
        {"ann_date": text_date("ann_date"), "end_date": text_date("end_date"), "dt_debt_to_assets": F.col("bps") * 2}
    )
    return frames.financials(feed).select("ts_code", "ann_date", "end_date", "eps", "bps", "dt_debt_ratio")


@query
def src_name_history_st(spark, sf_dir):
    feed = d.name_history(spark, sf_dir).select(
        "ts_code",
        "name",
        text_date("start_date").alias("start_date"),
        F.coalesce(text_date("end_date"), F.lit("open")).alias("end_date"),
        F.when(F.col("is_st"), "st mark").alias("change_reason"),
    )
    return frames.name_history(feed).select("ts_code", "name", "start_date", "end_date", "change_reason", "is_st")


@query
def instruments_union(spark, sf_dir):
    feed = d.instruments(spark, sf_dir).withColumns(
        {"list_date": text_date("list_date"), "delist_date": text_date("delist_date")}
    )
    listed = feed.drop("list_status", "delist_date")
    delisted = feed.filter("list_status = 'D'").drop("list_status")
    both = instrument_lists.union_listed_delisted(listed, delisted)
    return both.select("ts_code", "name", "list_date", "delist_date", "list_status")


@query
def instruments_from_codes(spark, sf_dir):
    codes = d.load(spark, sf_dir, "customer").select(
        (F.col("c_custkey") * 7919 % 1000000).cast("string").alias("code"), F.col("c_name").alias("name")
    )
    return instrument_lists.from_bare_codes(codes)


@query
def source_priority_pick(spark, sf_dir):
    rare = d.ticks(spark, sf_dir).filter("close > 200").groupBy(*BAR_KEY).agg(F.max("close").alias("close"))
    chosen = routing.pick_by_priority({"first": rare, "second": d.second_source(spark, sf_dir)})
    return chosen.select(*BAR_KEY, "close", "source")


@query
def source_windows(spark, sf_dir):
    """Two windows of every instrument: what the rare first source lacks the second fills, and the third the rest."""
    codes = d.bars(spark, sf_dir).select("ts_code").distinct()
    windows = F.array(*[F.struct(dated(a).alias("start_date"), dated(b).alias("end_date")) for a, b in d.WINDOWS])
    rare = d.ticks(spark, sf_dir).filter("close > 200").groupBy(*BAR_KEY).agg(F.max("close").alias("close"))
    every = d.bars(spark, sf_dir).select(*BAR_KEY, "close")
    requests = codes.select("ts_code", F.inline(windows))
    found = routing.fill_windows(requests, {"first": rare, "second": d.second_source(spark, sf_dir), "third": every})
    return found.select(*BAR_KEY, "close", "source")


@query
def as_of_reports(spark, sf_dir):
    found = asof.with_known_report(d.customer_bars(spark, sf_dir), d.restated_reports(spark, sf_dir), ("eps", "bps"))
    return found.select(*BAR_KEY, "close", "ann_date", "end_date", "eps", "bps")


@query
def batch_union(spark, sf_dir):
    parts = (d.bars(spark, sf_dir).drop("amount"), d.second_source(spark, sf_dir), d.factors(spark, sf_dir))
    return routing.union_batches(*parts)


# --- sinks ----------------------------------------------------------------------------------


def _stored_bars(spark, sf_dir):
    return d.bars(spark, sf_dir).filter(F.col("trade_date") <= dated(d.CUTOFF))


@query
def upsert_bars_partial(spark, sf_dir):
    path = stored_table(spark, DAILY_KLINE, _stored_bars(spark, sf_dir))
    batch = d.second_source(spark, sf_dir).filter(F.col("trade_date") >= dated("2024-01-15")).withColumn("vol", F.lit(None).cast("double"))
    upserts.upsert_bars(spark, path, batch)
    return table_state(spark, path, DAILY_KLINE).select(*BAR_KEY, *PRICES, "vol", "amount", *FLAGS)


@query
def upsert_rejects(spark, sf_dir):
    """Bars below 10 or without a close come without their day: refused, not stored and not lost."""
    path = scratch_path(spark, DAILY_KLINE.name)
    tables.init_table(spark, path, DAILY_KLINE)
    day = F.when(F.col("close") >= 10, F.col("trade_date"))
    batch = d.bars(spark, sf_dir).select("ts_code", day.alias("trade_date"), *PRICES, "vol", "amount")
    tables.upsert(spark, path, DAILY_KLINE, batch)
    stored = table_state(spark, path, DAILY_KLINE).select(*BAR_KEY, *PRICES, "vol", F.lit("stored").alias("fate"))
    row = F.from_json("row", "ts_code STRING, trade_date DATE, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, vol DOUBLE")
    refused = tables.rejected_rows(spark, path).select(row.alias("r"), "reason")
    return stored.unionByName(refused.select("r.*", F.col("reason").alias("fate")))


@query
def upsert_duplicate_factors(spark, sf_dir):
    """Each factor landed twice, the second time with another value: the first counts, bars stay single."""
    first = d.factors(spark, sf_dir).withColumn("ingest_seq", F.lit(0).cast("long"))
    again = first.withColumns({"adj_factor": F.col("adj_factor") + 1, "ingest_seq": F.lit(1).cast("long")})
    landed, path = d.landed_bars(spark, sf_dir), scratch_path(spark, "bars")
    tables.init_table(spark, path, DAILY_KLINE)
    pool = landed.select("ts_code").distinct()
    days = d.open_days(spark, sf_dir)
    run_full_refresh(spark, path, landed, pool, again.unionByName(first), days, d.FIRST_DAY, d.LAST_DAY, WIDE_MOVE)
    return _bar_state(spark, path)


@query
def run_outcomes(spark, sf_dir):
    """Outcome of every pool instrument after a daily run over the landed bars."""
    root = scratch_path(spark, "store")
    feeds = Feeds(
        d.calendar(spark, sf_dir), d.instruments(spark, sf_dir), d.landed_bars(spark, sf_dir), d.factors(spark, sf_dir),
        name_history=d.name_history(spark, sf_dir),
    )
    settings = Settings(base_start=d.FIRST_DAY, exclude_ipo_within_days=25, max_daily_pct=WIDE_MOVE, rules=RULES)
    daily_run(spark, root, feeds, 1, d.LAST_DAY, "2024-01-30 18:00:00", "2024-01-30 19:00:00", True, settings)
    return spark.read.parquet(outcomes_path(root, 1)).select("ts_code", "outcome", "n_rows")


@query
def upsert_bars_fixed(spark, sf_dir):
    path = stored_table(spark, DAILY_KLINE, _stored_bars(spark, sf_dir))
    batch = series.flag_suspended(d.landed_bars(spark, sf_dir).filter(F.col("trade_date") >= dated("2024-01-11"))).withColumns(
        {
            "close": r6(F.col("close") + 1),
            "pct_chg": F.lit(0.0),
            "adj_factor": F.lit(1.0),
            "flag_extreme": F.lit(False),
            "raw_close": F.lit(-1.0),  # not in the fixed list: must not arrive
        }
    )
    upserts.upsert_bars_fixed(spark, path, batch, order="ingest_seq")
    return table_state(spark, path, DAILY_KLINE).select(
        *BAR_KEY, *PRICES, "vol", "amount", "pct_chg", "adj_factor", "raw_close", "flag_extreme", "flag_suspended"
    )


@query
def upsert_daily_basic(spark, sf_dir):
    feed = _basic_feed(spark, sf_dir)
    path = stored_table(spark, DAILY_BASIC, feed.filter(F.col("trade_date") <= dated(d.CUTOFF)).withColumn("pe_ttm", F.col("pe")))
    changed = feed.filter(F.col("trade_date") >= dated("2024-01-11")).withColumn("pb", r6(F.col("pb") + 1))
    upserts.upsert_daily_basic(spark, path, changed)
    return table_state(spark, path, DAILY_BASIC)


@query
def upsert_financials(spark, sf_dir):
    reports = d.reports(spark, sf_dir)
    path = stored_table(spark, FINANCIAL_INDICATORS, _one_per_key(reports.filter(F.year("end_date") <= 1998)))
    newer = reports.filter(F.year("end_date") >= 1997).withColumn("eps", r6(F.col("eps") + 1))
    ordered = newer.withColumn("seq", F.datediff("end_date", dated("1990-01-01")))
    upserts.upsert_financials(spark, path, ordered, order="seq")
    return table_state(spark, path, FINANCIAL_INDICATORS).select("ts_code", "ann_date", "end_date", "eps", "bps", "roe")


def _one_per_key(reports):
    seq = F.datediff("end_date", dated("1990-01-01"))
    return series.dedup_first(reports.withColumn("seq", seq), ("ts_code", "ann_date"), "seq").drop("seq")


@query
def upsert_name_history(spark, sf_dir):
    history = d.name_history(spark, sf_dir)
    path = stored_table(spark, STOCK_NAME_HISTORY, history.filter(F.col("start_date") <= dated(d.CUTOFF)))
    ended = history.filter(F.col("start_date") >= dated("2024-01-11")).withColumn("end_date", F.date_add("start_date", 5))
    upserts.upsert_name_history(spark, path, ended)
    return table_state(spark, path, STOCK_NAME_HISTORY)


@query
def upsert_source_audit(spark, sf_dir):
    first = _audit(spark, sf_dir, "2024-01-05", "2024-01-12", "2024-02-01")
    path = stored_table(spark, DATA_SOURCE_AUDIT, first)
    for day in ("2024-02-01", "2024-03-01"):
        upserts.upsert_source_audit(spark, path, _audit(spark, sf_dir, "2024-01-10", "2024-01-25", day))
    return table_state(spark, path, DATA_SOURCE_AUDIT)


@query
def upsert_calendar(spark, sf_dir):
    days = d.order_calendar(spark, sf_dir)
    early = days.filter(F.year("trade_date") <= 1997).withColumn("pretrade_date", F.date_sub("trade_date", 1))
    path = stored_table(spark, TRADE_CALENDAR, early.withColumns(calendar_parts("trade_date")))
    later = days.filter(F.year("trade_date") >= 1996).withColumns(
        {"is_open": 1 - F.col("is_open"), "pretrade_date": F.date_sub("trade_date", 7)}
    )
    upserts.upsert_calendar(spark, path, later)
    return table_state(spark, path, TRADE_CALENDAR)


@query
def upsert_instruments(spark, sf_dir):
    whole = d.instruments(spark, sf_dir)
    old = whole.filter("exchange <> 'BSE'").withColumn("created_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    path = stored_table(spark, STOCK_LIST, old.withColumn("updated_at", F.col("created_at")))
    new = whole.filter("exchange <> 'SSE'").drop("area").withColumns(
        {"name": F.concat("name", F.lit(" B")), "symbol": F.lit("changed")}
    )
    upserts.upsert_instruments(spark, path, new, "2024-02-01 00:00:00")
    state = table_state(spark, path, STOCK_LIST)
    return state.withColumns({c: F.to_date(c) for c in ("created_at", "updated_at")})


@query
def full_refresh_bars(spark, sf_dir):
    old = _stored_bars(spark, sf_dir).withColumn("close", F.lit(1.0))
    path = stored_table(spark, DAILY_KLINE, old)
    pool = d.bars(spark, sf_dir).select("ts_code").distinct()
    run_full_refresh(
        spark, path, d.landed_bars(spark, sf_dir), pool, d.factors(spark, sf_dir), d.open_days(spark, sf_dir),
        d.FIRST_DAY, d.LAST_DAY, WIDE_MOVE,
    )
    return _bar_state(spark, path)


@query
def rebuild_bars(spark, sf_dir):
    """A table written from scratch at a new path, and the old one as it was."""
    old = stored_table(spark, DAILY_KLINE, _stored_bars(spark, sf_dir).withColumn("close", F.lit(1.0)))
    missing = {c: F.lit(None).cast(DAILY_KLINE.schema[c].dataType) for c in DAILY_KLINE.columns}
    clean = _clean(spark, sf_dir)
    rows = clean.withColumns({c: v for c, v in missing.items() if c not in clean.columns})
    tables.rebuild(spark, f"{old}-rebuilt", DAILY_KLINE, rows)
    both = [table_state(spark, p, DAILY_KLINE).withColumn("which", F.lit(w)) for p, w in ((old, "old"), (f"{old}-rebuilt", "new"))]
    return both[0].unionByName(both[1]).select("which", *BAR_KEY, *PRICES, "vol", "pct_chg", *FLAGS)


@query
def sql_store_day(spark, sf_dir):
    """The universe of a stored day in SQL that names the day alone."""
    root = scratch_path(spark, "store")
    init_store(spark, root)
    tables.upsert(spark, table_path(root, "daily_kline"), DAILY_KLINE, _clean(spark, sf_dir), unique=True)
    upserts.upsert_instruments(spark, table_path(root, "stock_list"), d.known_instruments(spark, sf_dir), "2024-01-01 00:00:00")
    upserts.upsert_name_history(spark, table_path(root, "stock_name_history"), d.name_history(spark, sf_dir))
    open_store(spark, root)
    return lookups.raw_sql(
        spark,
        "SELECT ts_code, trade_date, close, name, is_st_on_date, is_in_universe, exclude_reason FROM research_daily_universe"
        " WHERE trade_date = CAST(:day AS DATE)",
        {"day": d.A_DAY},
    )


def _bar_state(spark, path):
    return read_adjusted(spark, path).select(
        *BAR_KEY, *PRICES, "vol", "amount", "pct_chg", "adj_factor", *QFQ_PRICES, *FLAGS
    )


@query
def quality_report_json(spark, sf_dir):
    path = scratch_path(spark, "reports")
    upserts.save_reports(path, _report(spark, sf_dir))
    shape = (
        "date STRING, stock_count BIGINT, missing_rate MAP<STRING, DOUBLE>, suspension_ratio DOUBLE, "
        "extreme_stats MAP<STRING, STRUCT<count: BIGINT, ratio: DOUBLE>>, date_range STRUCT<min: STRING, max: STRING>, "
        "anomalies ARRAY<STRING>, status STRING, quality_score INT"
    )
    back = spark.read.schema(shape).json(path)
    extreme = F.try_element_at("extreme_stats", F.lit("pct_chg"))
    return back.select(
        "date", "stock_count", "status", "quality_score", "suspension_ratio",
        F.try_element_at("missing_rate", F.lit("high")).alias("missing_high"),
        extreme["count"].alias("extreme_count"), extreme["ratio"].alias("extreme_ratio"),
        F.col("date_range.min").alias("date_min"), F.col("date_range.max").alias("date_max"),
        F.size("anomalies").cast("long").alias("n_anomalies"),
    )


@query
def run_log_fold(spark, sf_dir):
    path = scratch_path(spark, "runlog")
    # log times are compared as wall-clock times
    records = d.run_records(spark, sf_dir)
    upserts.append_run_records(path, records.filter("start_time is not null"))
    ends = records.filter("end_time is not null")
    upserts.append_run_records(path, ends)
    log = runs.fold_run_log(spark.read.schema(PIPELINE_LOG.stored_schema).parquet(path))
    return log.select(
        "id", "run_date", F.to_date("start_time").alias("start_day"), F.to_date("end_time").alias("end_day"),
        "status", "stocks_fetched", "stocks_cleaned", "error_msg", r6("duration_sec").alias("duration_sec"),
    )


@query
def schema_evolve_read(spark, sf_dir):
    old_columns = [c for c in DAILY_KLINE.columns if c != "flag_invalid_ohlc"]
    missing = {c: F.lit(None).cast(DAILY_KLINE.schema[c].dataType) for c in old_columns}
    bars = series.flag_suspended(d.bars(spark, sf_dir))
    old = bars.withColumns({c: v for c, v in missing.items() if c not in bars.columns}).select(*old_columns)
    path = scratch_path(spark, "old_bars")
    month = DAILY_KLINE.partition_value()
    old.withColumn(DAILY_KLINE.partition, month).hint("rebalance", DAILY_KLINE.partition).write.partitionBy(DAILY_KLINE.partition).parquet(path)
    return table_state(spark, path, DAILY_KLINE).select(*BAR_KEY, "close", *FLAGS)


# --- projections and filters --------------------------------------------------------------------


@query
def clean_numeric(spark, sf_dir):
    logged = d.bars(spark, sf_dir).withColumns(
        {
            # as a float computation would give them: infinities and NaN
            "open": F.when(F.col("vol") == 0, F.lit(float("inf"))).otherwise(F.col("open")),
            "low": F.when(F.col("low") < 1, F.lit(float("-inf"))).otherwise(F.col("low")),
            "close": F.when(F.col("close") > 100, F.lit(float("nan"))).otherwise(F.col("close")),
        }
    )
    return null_non_finite(logged)


@query
def date_range_filter(spark, sf_dir):
    return lookups.between_days(d.bars(spark, sf_dir), "2024-01-10", "2024-01-20")


@query
def daily_range(spark, sf_dir):
    return lookups.daily_range(d.bars(spark, sf_dir), d.AN_INSTRUMENT, "2024-01-05", "2024-01-25", [*BAR_KEY, "close", "vol"])


@query
def cross_section(spark, sf_dir):
    return lookups.cross_section(d.bars(spark, sf_dir), d.basics(spark, sf_dir), d.A_DAY)


@query
def instruments_by_status(spark, sf_dir):
    return lookups.instruments_by_status(d.instruments(spark, sf_dir), "D")


@query
def stock_pool(spark, sf_dir):
    return universe.stock_pool(d.instruments(spark, sf_dir), "2024-03-01", ["SZSE", "SSE"], True, 60)


@query
def flag_st_codes(spark, sf_dir):
    listed = d.instruments(spark, sf_dir).filter(F.upper("name").contains("ST"))
    return series.flag_listed_codes(d.bars(spark, sf_dir), listed).select(*BAR_KEY, "is_st")


@query
def flag_extreme(spark, sf_dir):
    marked = series.flag_extreme(series.returns(d.bars(spark, sf_dir)), 15.0)
    return marked.select(*BAR_KEY, "close", "pct_chg", "flag_extreme")


@query
def flag_invalid_ohlc(spark, sf_dir):
    marked = series.flag_invalid_ohlc(d.bars(spark, sf_dir))
    return marked.select(*BAR_KEY, *PRICES, "flag_invalid_ohlc", "flag_extreme")


@query
def flag_suspended(spark, sf_dir):
    return series.flag_suspended(d.bars(spark, sf_dir)).select(*BAR_KEY, "vol", "flag_suspended")


def _clean(spark, sf_dir, max_daily_pct=WIDE_MOVE):
    return clean_bars(d.bars(spark, sf_dir), d.open_days(spark, sf_dir), max_daily_pct, order=None)


def _universe(spark, sf_dir):
    return universe.research_universe(_clean(spark, sf_dir), d.known_instruments(spark, sf_dir), d.name_history(spark, sf_dir))


@query
def exclude_reason(spark, sf_dir):
    reasons = _universe(spark, sf_dir).groupBy(F.coalesce("exclude_reason", F.lit("none")).alias("reason"))
    return reasons.agg(F.count("*").alias("n_rows"), F.count_if("is_in_universe").alias("n_in_universe"))


@query
def research_universe(spark, sf_dir):
    day = universe.universe_on(_universe(spark, sf_dir), d.A_DAY)
    return day.select(*BAR_KEY, "close", "pct_chg", "name", "industry", "is_st_on_date", "is_in_universe")


# --- joins ------------------------------------------------------------------------------------------


@query
def adj_factor_join(spark, sf_dir):
    joined = adjust.join_factors(d.bars(spark, sf_dir), d.factors(spark, sf_dir))
    return joined.select(*BAR_KEY, "close", "adj_factor")


@query
def universe_meta_join(spark, sf_dir):
    joined = universe.with_instrument_meta(d.bars(spark, sf_dir), d.known_instruments(spark, sf_dir))
    return joined.select(*BAR_KEY, "close", "name", "area", "industry", "list_date", "delist_date", "has_meta")


@query
def st_interval_join(spark, sf_dir):
    return universe.count_covering_intervals(d.bars(spark, sf_dir), d.name_history(spark, sf_dir))


@query
def source_compare(spark, sf_dir):
    return audit.compare_sources(d.bars(spark, sf_dir), d.second_source(spark, sf_dir))


@query
def calendar_align(spark, sf_dir):
    aligned = calendar.calendar_align(d.bars(spark, sf_dir), d.open_days(spark, sf_dir))
    return aligned.select(*BAR_KEY, *PRICES, "vol", "amount", "flag_aligned")


@query
def prev_trade_date(spark, sf_dir):
    return calendar.previous_open_day(d.order_calendar(spark, sf_dir))


@query
def incremental_plan_(spark, sf_dir):
    # instruments without a bar before the cutoff are new; some are up to date
    pool = d.instruments(spark, sf_dir)
    return incremental_plan(pool, _stored_bars(spark, sf_dir), "2024-01-05", d.CUTOFF)


# --- aggregations --------------------------------------------------------------------------------------


@query
def latest_date(spark, sf_dir):
    return lookups.latest_date(d.bars(spark, sf_dir))


@query
def latest_date_one(spark, sf_dir):
    return lookups.latest_date(d.bars(spark, sf_dir), d.AN_INSTRUMENT)


@query
def latest_date_by_stock(spark, sf_dir):
    return lookups.latest_date_by_stock(d.bars(spark, sf_dir))


@query
def stock_count(spark, sf_dir):
    bars = d.bars(spark, sf_dir)
    on_day = lookups.stock_count(bars, d.A_DAY).withColumn("scope", F.lit("day"))
    return on_day.unionByName(lookups.stock_count(bars).withColumn("scope", F.lit("all")))


@query
def table_row_counts(spark, sf_dir):
    stored = {
        "daily_kline": d.bars(spark, sf_dir),
        "daily_basic": d.basics(spark, sf_dir),
        "financial_indicators": d.reports(spark, sf_dir),
        "trade_calendar": d.calendar(spark, sf_dir),
        "stock_list": d.instruments(spark, sf_dir),
    }
    return lookups.row_counts(stored)


@query
def date_range(spark, sf_dir):
    return lookups.date_range(d.bars(spark, sf_dir))


@query
def st_on_date(spark, sf_dir):
    marked = universe.with_st_on_date(d.bars(spark, sf_dir), d.name_history(spark, sf_dir))
    return marked.select(*BAR_KEY, "is_st_on_date")


def _sections(spark, sf_dir):
    """Cross-sections of clean, adjusted bars at the default move threshold."""
    bars = clean_and_adjust(d.bars(spark, sf_dir), d.factors(spark, sf_dir), d.open_days(spark, sf_dir), order=None)
    return bars, lookups.cross_sections(bars, d.basics(spark, sf_dir))


BASIC_RULES = quality.QualityRules(min_stock_count=100, known_missing=("amount",), with_basics=True)


def _report(spark, sf_dir, rules=RULES):
    bars = clean_and_adjust(d.bars(spark, sf_dir), d.factors(spark, sf_dir), d.open_days(spark, sf_dir), order=None)
    day = F.col("trade_date")
    requested = d.calendar(spark, sf_dir).select(F.explode(F.array(day, F.date_add(day, 2))).alias("trade_date"))
    return quality.store_report(bars, d.basics(spark, sf_dir), d.AS_OF, rules, requested)


@query
def missing_rates(spark, sf_dir):
    return quality.missing_rates(_sections(spark, sf_dir)[1], BASIC_RULES).select("trade_date", "field", "rate")


@query
def extreme_stats(spark, sf_dir):
    return quality.extreme_stats(_sections(spark, sf_dir)[1])


@query
def suspension_stats(spark, sf_dir):
    return quality.suspension_stats(_sections(spark, sf_dir)[1])


def _outlier_flags(spark, sf_dir, method, limit=None):
    marked = outliers.flag_outliers(d.bars(spark, sf_dir), "close", method, limit)
    return marked.select(*BAR_KEY, "close", "is_outlier")


@query
def outlier_mad(spark, sf_dir):
    return _outlier_flags(spark, sf_dir, "mad")


@query
def outlier_zscore(spark, sf_dir):
    return _outlier_flags(spark, sf_dir, "zscore")


@query
def outlier_iqr(spark, sf_dir):
    return _outlier_flags(spark, sf_dir, "iqr")


@query
def winsorize(spark, sf_dir):
    bars = d.bars(spark, sf_dir)
    for method in ("mad", "zscore", "iqr"):
        bars = outliers.winsorize(bars, "close", method, name=f"close_{method}")
    names = [f"close_{m}" for m in ("mad", "zscore", "iqr")]
    return rounded(bars, *names).select(*BAR_KEY, "close", *names)


def _audit(spark, sf_dir, start, end, audit_date, codes=None):
    """The second source lacks instruments of the Beijing board; codes include unknown ones."""
    codes = d.instruments(spark, sf_dir) if codes is None else codes
    secondary = d.second_source(spark, sf_dir).filter(~F.col("ts_code").endswith(".BJ"))
    return audit.audit_sources(codes, d.bars(spark, sf_dir), secondary, start, end, audit_date)


@query
def source_audit(spark, sf_dir):
    return _audit(spark, sf_dir, "2024-01-10", "2024-01-25", d.AS_OF)


@query
def days_since_success(spark, sf_dir):
    return runs.days_since_success(runs.fold_run_log(d.run_records(spark, sf_dir)), "2001-08-05")


@query
def open_days_per_year(spark, sf_dir):
    return lookups.open_days_per_year(d.order_calendar(spark, sf_dir))


@query
def run_status(spark, sf_dir):
    tallies = runs.run_tallies(d.outcomes(spark, sf_dir), "trade_date")
    report = _report(spark, sf_dir).select("trade_date", F.col("status").alias("report_status"))
    return tallies.join(report, "trade_date", "left").withColumn("status", runs.run_status(F.col("report_status")))


@query
def quality_score(spark, sf_dir):
    return _report(spark, sf_dir).select("trade_date", "quality_score")


@query
def quality_anomalies(spark, sf_dir):
    return quality.anomaly_rows(_report(spark, sf_dir))


@query
def quality_status(spark, sf_dir):
    return _report(spark, sf_dir).select("trade_date", "status")


@query
def quality_report(spark, sf_dir):
    flat = _report(spark, sf_dir, BASIC_RULES)
    rate = lambda c: F.try_element_at("missing_rate", F.lit(c)).alias(f"missing_{c}")
    return flat.select(
        "trade_date", "stock_count", *[rate(c) for c in ("high", "adj_factor", "pe")],
        F.col("extreme_stats.count").alias("extreme_count"), F.col("extreme_stats.ratio").alias("extreme_ratio"),
        "suspension_count", "suspension_ratio", "invalid_ohlc_count",
        F.col("date_range.min").alias("date_min"), F.col("date_range.max").alias("date_max"),
        F.size("anomalies").cast("long").alias("n_anomalies"), "status", "quality_score",
    )


@query
def quality_summary(spark, sf_dir):
    return quality.summary_lines(_report(spark, sf_dir))


# --- series -----------------------------------------------------------------------------------------------


@query
def pct_chg(spark, sf_dir):
    return series.returns(d.bars(spark, sf_dir)).select(*BAR_KEY, "close", "pct_chg")


@query
def log_ret(spark, sf_dir):
    return rounded(series.returns(d.bars(spark, sf_dir)), "log_ret").select(*BAR_KEY, "close", "log_ret")


@query
def forward_fill(spark, sf_dir):
    return series.forward_fill(d.bars(spark, sf_dir)).select(*BAR_KEY, *PRICES, "vol")


@query
def fill_both_ways(spark, sf_dir):
    joined = adjust.join_factors(d.bars(spark, sf_dir), d.factors(spark, sf_dir))
    return series.fill_both_ways(joined, ["adj_factor"]).select(*BAR_KEY, "adj_factor")


def _adjusted(spark, sf_dir, method):
    adjusted = adjust.adjust_prices(d.bars(spark, sf_dir), d.factors(spark, sf_dir), method)
    names = [f"adj_{p}" for p in PRICES]
    return adjusted.select(*BAR_KEY, "adj_factor", *names)


@query
def adjust_none(spark, sf_dir):
    return _adjusted(spark, sf_dir, "none")


@query
def adjust_hfq(spark, sf_dir):
    return _adjusted(spark, sf_dir, "hfq")


@query
def adjust_qfq(spark, sf_dir):
    return _adjusted(spark, sf_dir, "qfq")


@query
def dedup_first(spark, sf_dir):
    return series.dedup_first(d.ticks(spark, sf_dir))


@query
def aligned_returns(spark, sf_dir):
    aligned = series.forward_fill(calendar.calendar_align(d.bars(spark, sf_dir), d.open_days(spark, sf_dir)))
    zeroed = series.zero_aligned_returns(series.returns(aligned))
    return rounded(zeroed, "log_ret").select(*BAR_KEY, "flag_aligned", "pct_chg", "log_ret")


# --- top-k, sets, scalars ------------------------------------------------------------------------------------


@query
def recent_trade_dates(spark, sf_dir):
    return lookups.recent_trade_dates(d.calendar(spark, sf_dir), d.A_DAY, 5)


@query
def recent_runs(spark, sf_dir):
    log = lookups.recent_runs(runs.fold_run_log(d.run_records(spark, sf_dir)), 10)
    return log.select("id", "run_date", "status", "stocks_fetched")


@query
def head_n_codes(spark, sf_dir):
    pool = universe.stock_pool(d.instruments(spark, sf_dir), "2024-03-01", ["SZSE", "SSE"], head=5)
    return pool


@query
def missing_top5(spark, sf_dir):
    return quality.missing_top(_sections(spark, sf_dir)[1], 5, BASIC_RULES)


@query
def build_calendar(spark, sf_dir):
    return calendar.build_calendar(d.calendar(spark, sf_dir), d.order_calendar(spark, sf_dir), first_year=1996, last_year=2024)


@query
def sym_exchange_map(spark, sf_dir):
    symbols = d.load(spark, sf_dir, "customer").select(
        zero_pad((F.col("c_custkey") * 7919 % 1000000).cast("string"), 6).alias("symbol")
    )
    return symbols.select(
        "symbol",
        exchange_of("symbol").alias("exchange"),
        ts_code_of("symbol").alias("ts_code"),
        symbol_of(ts_code_of("symbol")).alias("back"),
    )


@query
def date_normalize(spark, sf_dir):
    key = F.col("o_orderkey")
    raw = d.load(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 4 == 0, F.date_format("o_orderdate", "yyyyMMdd"))
        .when(key % 4 == 1, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(key % 4 == 2, F.lit("Today"))
        .when(key % 16 == 7, F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("9")))
        .when(key % 16 == 11, F.lit("2024-1-15 10:00"))
        .when(key % 16 == 15, F.concat(F.lit(" "), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" 10:00:00 ")))
        .otherwise(F.lit("n/a"))
        .alias("raw_date"),
        F.when(key % 3 == 0, F.lit("--")).otherwise(F.col("o_totalprice").cast("string")).alias("raw_number"),
    )
    # parsed once, then used by name: the parse is not repeated inside every expression
    parsed = raw.select("o_orderkey", request_day("raw_date", d.AS_OF).alias("request_date"), number("raw_number").alias("price"))
    lookback = parsed.withColumn("overlap_date", F.date_sub("request_date", 10))
    return lookback.withColumn("business_days", business_days("overlap_date", "request_date").cast("long"))


@query
def calendar_parts_(spark, sf_dir):
    return calendar.with_calendar_parts(d.order_calendar(spark, sf_dir))


# --- dataflows ---------------------------------------------------------------------------------------------------


CLEAN_COLUMNS = (*BAR_KEY, *PRICES, "vol", "amount", "pct_chg", "log_ret", *FLAGS)


@query
def clean_bars_(spark, sf_dir):
    cleaned = clean_bars(d.landed_bars(spark, sf_dir), d.open_days(spark, sf_dir))
    return rounded(cleaned, "log_ret").select(*CLEAN_COLUMNS)


@query
def clean_supplier_bars(spark, sf_dir):
    cleaned = clean_bars(d.supplier_bars(spark, sf_dir), d.shipping_days(spark, sf_dir), order=None)
    return rounded(cleaned, "log_ret").select(*BAR_KEY, *PRICES, "vol", "pct_chg", "log_ret", *FLAGS)


@query
def clean_and_adjust_(spark, sf_dir):
    rows = clean_and_adjust(d.landed_bars(spark, sf_dir), d.factors(spark, sf_dir), d.open_days(spark, sf_dir))
    return rows.select(
        *BAR_KEY, *PRICES, "vol", "pct_chg", "adj_factor", *QFQ_PRICES, *FLAGS
    )


@query
def research_universe_view(spark, sf_dir):
    view = _universe(spark, sf_dir)
    return view.select(
        *BAR_KEY, "close", "pct_chg", "name", "list_status", "is_st_on_date", "is_listed_on_date",
        "is_in_universe", "exclude_reason",
    )


@query
def incremental_merge(spark, sf_dir):
    landed, factors, days = d.landed_bars(spark, sf_dir), d.factors(spark, sf_dir), d.open_days(spark, sf_dir)
    pool = landed.select("ts_code").distinct()
    cut = dated(d.CUTOFF)
    path = scratch_path(spark, "bars")
    tables.init_table(spark, path, DAILY_KLINE)
    early = lambda df: df.filter(F.col("trade_date") <= cut)
    run_full_refresh(spark, path, early(landed), pool, early(factors), days, d.FIRST_DAY, d.CUTOFF, WIDE_MOVE)
    run_incremental(spark, path, landed, pool, factors, days, d.FIRST_DAY, d.LAST_DAY, WIDE_MOVE)
    return _bar_state(spark, path)


@query
def source_audit_sample(spark, sf_dir):
    pool = universe.stock_pool(d.instruments(spark, sf_dir), "2024-03-01", ["SZSE", "SSE"])
    return sampled_source_audit(pool, d.bars(spark, sf_dir), d.second_source(spark, sf_dir), "2024-01-25", d.AS_OF, sample_size=10)


@query
def stream_upsert_bars_(spark, sf_dir):
    landing, path, checkpoint, again = (scratch_path(spark, n) for n in ("landing", "bars", "stream", "stream"))
    feed = d.landed_bars(spark, sf_dir)
    # the second landing corrects the last days of the first one and adds later ones
    early = feed.filter(F.col("trade_date") <= dated(d.CUTOFF))
    corrected = feed.filter(F.col("trade_date") >= dated(d.CORRECTED_FROM)).withColumn("close", F.col("close") + 1)
    for part in (early, corrected):
        part.write.mode("append").parquet(landing)
        stream_upsert_bars(spark, landing, feed.schema, path, checkpoint).awaitTermination()
    # a stream that has lost its checkpoint reads both again, and changes nothing
    stream_upsert_bars(spark, landing, feed.schema, path, again, files_per_batch=1).awaitTermination()
    return table_state(spark, path, DAILY_KLINE).select(*BAR_KEY, *PRICES, "vol", "amount", *FLAGS)


@query
def raw_sql(spark, sf_dir):
    d.bars(spark, sf_dir).createOrReplaceTempView("daily_kline")
    return lookups.raw_sql(
        spark,
        "SELECT trade_date, count(*) AS n_rows, max(close) AS top_close FROM daily_kline"
        " WHERE trade_date >= CAST(:start AS DATE) AND close > :floor GROUP BY trade_date",
        {"start": "2024-01-10", "floor": 10.0},
    )
