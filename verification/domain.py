"""Market data derived from the driver's tables, all of it over whole tables.

A user is an instrument, its events of a day are the ticks of a daily bar.  Gaps, days
without volume, unknown or contradictory highs and weekend bars occur by themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from barlake.functions.codes import ts_code_of, zero_pad

# last stored day of the incremental and streaming queries; later bars count as new
CUTOFF = "2024-01-20"
FIRST_DAY = "2024-01-01"
LAST_DAY = "2024-01-30"
AS_OF = "2024-02-01"
CORRECTED_FROM = "2024-01-15"
WINDOWS = (("2024-01-03", "2024-01-10"), ("2024-01-15", "2024-01-25"))
A_DAY = "2024-01-16"
AN_INSTRUMENT = "300007.SZ"


_SCHEMAS: dict[str, StructType] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table.  Its schema is inferred once; naming it saves a job per later read."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def symbol(number: str) -> Column:
    """A digit that decides the exchange, then the number padded to five places."""
    digit = F.substr(F.lit("60394"), (F.col(number) % 5 + 1).cast("int"), F.lit(1))
    return F.concat(digit, zero_pad(number, 5))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        load(spark, sf_dir, "events")
        .withColumn("ts_code", ts_code_of(symbol("user_id")))
        .withColumn("trade_date", F.to_date("ts"))
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a landed one-price bar; many per instrument and day."""
    value = F.col("value")
    return _events(spark, sf_dir).select(
        "ts_code", "trade_date",
        *[value.alias(p) for p in ("open", "high", "low", "close")],
        F.lit(1.0).alias("vol"),
        F.col("event_id").alias("ingest_seq"),
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One daily bar per instrument."""
    value, kind = F.col("value"), F.col("event_type")
    return _events(spark, sf_dir).groupBy("ts_code", "trade_date").agg(
        F.min_by(value, "ts").alias("open"),
        F.max(F.when(kind != "signup", value)).alias("high"),
        F.min(value).alias("low"),
        F.max_by(value, "ts").alias("close"),
        F.count(F.when(kind != "error", 1)).cast("double").alias("vol"),
        F.round(F.sum(value), 2).alias("amount"),
    )


def with_symbol(frame: DataFrame) -> DataFrame:
    return frame.withColumn("symbol", F.substring_index("ts_code", ".", 1))


def second_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closes of a source that does not see clicks."""
    return (
        _events(spark, sf_dir).filter("event_type <> 'click'")
        .groupBy("ts_code", "trade_date").agg(F.max_by("value", "ts").alias("close"))
    )


def landed_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars, and afterwards the second source's closes for the same keys."""
    late = second_source(spark, sf_dir).withColumn("ingest_seq", F.lit(1).cast("long"))
    return bars(spark, sf_dir).withColumn("ingest_seq", F.lit(0).cast("long")).unionByName(late, allowMissingColumns=True)


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days with events; weekdays are open."""
    days = load(spark, sf_dir, "events").select(F.to_date("ts").alias("trade_date")).distinct()
    return days.withColumn("is_open", F.when(F.weekday("trade_date") < 5, 1).otherwise(0))


def order_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days with orders; weekdays are open.  Several years."""
    days = load(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("trade_date")).distinct()
    return days.withColumn("is_open", F.when(F.weekday("trade_date") < 5, 1).otherwise(0))


def open_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar(spark, sf_dir).filter("is_open = 1").select("trade_date")


def factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjustment factors, on days with a signup only."""
    return (
        _events(spark, sf_dir).filter("event_type = 'signup'")
        .groupBy("ts_code", "trade_date")
        .agg((F.lit(1) + (F.max("event_id") % 100).cast("double") / 100).alias("adj_factor"))
    )


def instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers; a negative balance is an ST name."""
    nation = load(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("area"))
    key = F.col("c_custkey")
    return (
        load(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .withColumn("symbol", symbol("c_custkey"))
        .select(
            ts_code_of("symbol").alias("ts_code"),
            "symbol",
            F.concat(F.when(F.col("c_acctbal") < 0, "*St ").otherwise(""), F.replace("c_name", F.lit("Customer#"), F.lit("Corp "))).alias("name"),
            F.when(F.substring("symbol", 1, 1) == "6", "SSE")
            .when(F.substring("symbol", 1, 1).isin("0", "3"), "SZSE").otherwise("BSE").alias("exchange"),
            "area",
            F.col("c_mktsegment").alias("industry"),
            F.when(key % 11 != 0, F.date_add(F.lit("2023-12-28").cast("date"), (key % 10).cast("int"))).alias("list_date"),
            F.when(key % 13 == 0, F.lit("2024-01-20").cast("date")).alias("delist_date"),
            F.when(key % 13 == 0, "D").otherwise("L").alias("list_status"),
        )
    )


def known_instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For the universe: metadata of the BUILDING segment is missing."""
    return instruments(spark, sf_dir).filter("industry <> 'BUILDING'")


def name_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name intervals from errors above 100: three days long, some open-ended, some ST."""
    start = F.col("trade_date")
    return (
        _events(spark, sf_dir).filter("event_type = 'error' and value > 100")
        .select(
            "ts_code",
            F.concat(F.lit("N"), F.col("event_id").cast("string")).alias("name"),
            start.alias("start_date"),
            F.when(F.col("event_id") % 7 != 0, F.date_add(start, 2)).alias("end_date"),
            F.when(F.col("value") > 120, "ST").otherwise("rename").alias("change_reason"),
            (F.col("value") > 120).alias("is_st"),
        )
    )


def basics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse daily fundamentals."""
    return (
        _events(spark, sf_dir).filter("event_type = 'purchase'")
        .groupBy("ts_code", "trade_date")
        .agg(
            F.max("value").alias("pe"),
            F.min("value").alias("pb"),
            F.count("*").cast("double").alias("turnover_rate"),
        )
    )


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One report per customer and quarter, announced 30 days after its last order."""
    last = F.to_date(F.max("o_orderdate"))
    return (
        load(spark, sf_dir, "orders")
        .groupBy(symbol("o_custkey").alias("symbol"), F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q"))
        .agg(last.alias("end_date"), F.max("o_totalprice").alias("eps"), F.count("*").cast("double").alias("bps"))
        .select(
            ts_code_of("symbol").alias("ts_code"), F.date_add("end_date", 30).alias("ann_date"), "end_date", "eps", "bps"
        )
    )


def restated_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reports, and a third of them announced once more 100 days later."""
    first = reports(spark, sf_dir)
    again = first.filter(F.floor("eps") % 3 == 0).withColumns({"ann_date": F.date_add("ann_date", 100), "eps": F.col("eps") + 1})
    return first.unionByName(again)


def customer_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A close per customer and day with orders, over the years of the reports."""
    return (
        load(spark, sf_dir, "orders")
        .groupBy(ts_code_of(symbol("o_custkey")).alias("ts_code"), F.to_date("o_orderdate").alias("trade_date"))
        .agg(F.max("o_totalprice").alias("close"))
    )


def supplier_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The large one: a bar per supplier and shipping day, ticks in order of order, line, part."""
    price = F.col("l_extendedprice") / F.col("l_quantity")
    tick = F.struct("l_orderkey", "l_linenumber", "l_partkey")
    return (
        load(spark, sf_dir, "lineitem")
        .groupBy(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("ts_code"), F.to_date("l_shipdate").alias("trade_date"))
        .agg(
            F.min_by(price, tick).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"),
            F.max_by(price, tick).alias("close"), F.sum("l_quantity").alias("vol"),
        )
    )


def shipping_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekdays on which anything was shipped."""
    days = load(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("trade_date")).distinct()
    return days.filter(F.weekday("trade_date") < 5)


def run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order is a run: it starts on the order day and ends, unless still open, with its
    last shipment.  Start and end are separate records, as the log appends them."""
    orders = load(spark, sf_dir, "orders")
    lines = load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("end_time"), F.count("*").cast("int").alias("n_lines")
    )
    state = F.col("o_orderstatus")
    started = orders.select(
        F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("run_date"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("start_time"),
    )
    ended = (
        orders.filter(state != "O").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .select(
            F.col("o_orderkey").alias("id"),
            F.col("end_time").cast("timestamp_ntz").alias("end_time"),
            F.when(state == "F", "success").otherwise("failed").alias("status"),
            F.col("n_lines").alias("stocks_fetched"), F.col("n_lines").alias("stocks_cleaned"),
            F.when(state == "P", "source returned empty data").alias("error_msg"),
            F.lit(None).cast("string").alias("quality_report"),
        )
    )
    return started.unionByName(ended, allowMissingColumns=True)


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome per day and instrument: no volume fails, weekend bars count as up to date."""
    kind = (
        F.when(F.col("vol") == 0, "failed").when(F.weekday("trade_date") >= 5, "up_to_date").otherwise("cleaned")
    )
    return bars(spark, sf_dir).select("ts_code", "trade_date", kind.alias("outcome"), F.col("vol").cast("long").alias("n_rows"))
