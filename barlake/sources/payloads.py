"""Raw JSON responses, one per line, to bars.

Input frames have ``symbol`` and ``payload`` columns.  A response with malformed JSON,
an error code or no bars yields no rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barlake.functions.codes import ts_code_of
from barlake.functions.columns import number, ratio
from barlake.functions.dates import day
from barlake.operators.lookups import between_days
from barlake.schemas import PRICES

# Shares per traded lot in the feeds that count lots.
LOT = 100

# Key of the bar array in a response, by price type.
DAY_KEY = {"none": "day", "qfq": "qfqday", "hfq": "hfqday"}
# Market prefix of a symbol in that response; other symbols are not served.
MARKET_BY_FIRST_DIGIT = {"0": "sz", "3": "sz", "6": "sh"}


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Text files of lines ``symbol<TAB>response``."""
    line = F.split("value", "\t", 2)
    return spark.read.text(path).select(F.get(line, F.lit(0)).alias("symbol"), F.get(line, F.lit(1)).alias("payload"))


def _add_raw_prices(bars: DataFrame, price_type: str) -> DataFrame:
    return bars.withColumns({f"raw_{p}": F.col(p) for p in PRICES}) if price_type == "none" else bars


def _in_range(bars: DataFrame, start: str | None, end: str | None) -> DataFrame:
    return bars if start is None or end is None else between_days(bars, start, end)


def _nested_item(item: Column) -> Column:
    """Array item ``[date, open, close, high, low, lots, ...]``; the date leads the sort."""
    part = lambda i: F.get(item, F.lit(i))
    return F.struct(
        day(part(0)).alias("trade_date"),
        number(part(1)).alias("open"),
        number(part(3)).alias("high"),
        number(part(4)).alias("low"),
        number(part(2)).alias("close"),
        (number(part(5)) * LOT).alias("vol"),
    )


def nested_array_bars(
    payloads: DataFrame, start: str | None = None, end: str | None = None, price_type: str = "none"
) -> DataFrame:
    """``{"code":0,"data":{"sz000001":{"day":[[date,open,close,high,low,lots],...]}}}``.

    Items with fewer than six parts are skipped.  Volume is in lots.  The return is taken
    over the whole response, before the date range is cut.  No turnover, no factor."""
    price_type = price_type if price_type in DAY_KEY else "none"
    quotes = ", ".join(f"{key}: ARRAY<ARRAY<STRING>>" for key in DAY_KEY.values())
    body = F.from_json("payload", f"code INT, data MAP<STRING, STRUCT<{quotes}>>")
    market = F.try_element_at(
        F.create_map(*[F.lit(x) for item in MARKET_BY_FIRST_DIGIT.items() for x in item]), F.substring("symbol", 1, 1)
    )
    quote = F.try_element_at(body["data"], F.concat(market, F.col("symbol")))
    good = F.when(body["code"] == 0, quote[DAY_KEY[price_type]])
    parsed = F.transform(F.filter(good, lambda item: F.size(item) >= 6), _nested_item)
    # the previous bar is looked up inside the response's own array: no shuffle
    with_previous = F.transform(
        "bars", lambda bar, i: F.struct(bar.alias("bar"), F.get("bars", i - 1)["close"].alias("previous"))
    )
    bars = (
        payloads.select("symbol", F.array_sort(parsed).alias("bars"))
        .select("symbol", F.inline(with_previous))
        .select(
            ts_code_of("symbol").alias("ts_code"),
            "bar.trade_date",
            *[f"bar.{p}" for p in PRICES],
            "bar.vol",
            F.lit(None).cast("double").alias("amount"),
            ((ratio(F.col("bar.close"), F.col("previous")) - 1) * 100).alias("pct_chg"),
            F.lit(None).cast("double").alias("adj_factor"),
            F.lit(price_type).alias("price_type"),
            F.lit(False).alias("flag_extreme"),
            F.lit(False).alias("flag_suspended"),
        )
    )
    return _in_range(_add_raw_prices(bars, price_type), start, end)


def csv_line_bars(payloads: DataFrame, price_type: str = "none") -> DataFrame:
    """``{"data":{"klines":["date,open,close,high,low,lots,turnover,_,pct,_,_",...]}}``.

    Lines with fewer than eleven parts are skipped.  Volume is in lots."""
    body = F.from_json("payload", "data STRUCT<klines: ARRAY<STRING>>")
    part = lambda i: F.get("part", F.lit(i))
    bars = (
        payloads.select("symbol", F.explode(body["data"]["klines"]).alias("line"))
        .withColumn("part", F.split("line", ","))
        .filter(F.size("part") >= 11)
        .select(
            ts_code_of("symbol").alias("ts_code"),
            day(part(0)).alias("trade_date"),
            number(part(1)).alias("open"),
            number(part(3)).alias("high"),
            number(part(4)).alias("low"),
            number(part(2)).alias("close"),
            (number(part(5)) * LOT).alias("vol"),
            number(part(6)).alias("amount"),
            number(part(8)).alias("pct_chg"),
            F.lit(None).cast("double").alias("adj_factor"),
            F.lit(price_type).alias("price_type"),
            F.lit(False).alias("flag_extreme"),
            F.lit(False).alias("flag_suspended"),
        )
    )
    return _add_raw_prices(bars, price_type)


def object_array_bars(payloads: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """``[{"day":..,"open":..,"high":..,"low":..,"close":..,"volume":..},...]``, all strings.

    Unparsable numbers are NULL.  Volume is in shares; no turnover."""
    fields = "day STRING, open STRING, high STRING, low STRING, close STRING, volume STRING"
    rows = payloads.select("symbol", F.inline(F.from_json("payload", f"ARRAY<STRUCT<{fields}>>")))
    bars = rows.select(
        ts_code_of("symbol").alias("ts_code"),
        day("day").alias("trade_date"),
        *[number(p).alias(p) for p in PRICES],
        number("volume").alias("vol"),
        F.lit(None).cast("double").alias("amount"),
    )
    return _in_range(bars, start, end)
