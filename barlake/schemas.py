"""Table contracts: columns, primary keys, insert defaults and the storage partition.

The storage partition of every table is a function of its primary key, so an upsert
only has to read and rewrite the partitions its batch touches."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

PRICES = ("open", "high", "low", "close")
FLAGS = ("flag_extreme", "flag_suspended", "flag_aligned", "flag_invalid_ohlc")
QFQ_PRICES = tuple(f"adj_{p}_qfq" for p in PRICES)
RAW_PRICES = tuple(f"raw_{p}" for p in PRICES)
BAR_KEY = ("ts_code", "trade_date")


def _struct(columns: list[tuple[str, DataType]]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in columns])


_STR, _DBL, _DAY = StringType(), DoubleType(), DateType()
_INT, _LONG, _BOOL, _TS = IntegerType(), LongType(), BooleanType(), TimestampType()


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: StructType
    key: tuple[str, ...]
    partition: str
    partition_value: Callable[[], Column]
    # values that a *new* row takes for columns the batch does not carry
    insert_defaults: dict[str, object] = field(default_factory=dict)
    append_only: bool = False

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def stored_schema(self) -> StructType:
        return StructType([*self.schema.fields, StructField(self.partition, _STR, True)])


def month_of(column: str) -> Callable[[], Column]:
    return lambda: F.date_format(column, "yyyy-MM")


def market_of(column: str) -> Column:
    """The suffix of a code; unknown or missing suffixes share one partition."""
    suffix = F.split_part(column, F.lit("."), F.lit(-1))
    return F.when(suffix.isin("SZ", "SH", "BJ"), suffix).otherwise(F.lit("other"))


def year_of(column: str) -> Callable[[], Column]:
    return lambda: F.date_format(column, "yyyy")


# Names, types and order of the columns of all tables.
STOCK_LIST = TableSpec(
    "stock_list",
    _struct(
        [
            ("ts_code", _STR),
            ("symbol", _STR),
            ("name", _STR),
            ("exchange", _STR),
            ("area", _STR),
            ("industry", _STR),
            ("list_date", _DAY),
            ("delist_date", _DAY),
            ("list_status", _STR),
            ("created_at", _TS),
            ("updated_at", _TS),
        ]
    ),
    key=("ts_code",),
    partition="market",
    partition_value=lambda: market_of("ts_code"),
    insert_defaults={"list_status": "L"},
)

DAILY_KLINE = TableSpec(
    "daily_kline",
    _struct(
        [
            ("ts_code", _STR),
            ("trade_date", _DAY),
            ("open", _DBL),
            ("high", _DBL),
            ("low", _DBL),
            ("close", _DBL),
            ("vol", _DBL),
            ("amount", _DBL),
            ("pct_chg", _DBL),
            ("adj_factor", _DBL),
            ("adj_open_qfq", _DBL),
            ("adj_high_qfq", _DBL),
            ("adj_low_qfq", _DBL),
            ("adj_close_qfq", _DBL),
            ("raw_open", _DBL),
            ("raw_high", _DBL),
            ("raw_low", _DBL),
            ("raw_close", _DBL),
            ("flag_extreme", _BOOL),
            ("flag_suspended", _BOOL),
            ("flag_aligned", _BOOL),
            ("flag_invalid_ohlc", _BOOL),
        ]
    ),
    key=BAR_KEY,
    partition="trade_month",
    partition_value=month_of("trade_date"),
    insert_defaults={flag: False for flag in FLAGS},
)

DAILY_BASIC = TableSpec(
    "daily_basic",
    _struct(
        [
            ("ts_code", _STR),
            ("trade_date", _DAY),
            ("pe", _DBL),
            ("pe_ttm", _DBL),
            ("pb", _DBL),
            ("turnover_rate", _DBL),
            ("volume_ratio", _DBL),
            ("circ_mv", _DBL),
            ("total_mv", _DBL),
        ]
    ),
    key=BAR_KEY,
    partition="trade_month",
    partition_value=month_of("trade_date"),
)

FINANCIAL_INDICATORS = TableSpec(
    "financial_indicators",
    _struct(
        [
            ("ts_code", _STR),
            ("ann_date", _DAY),
            ("end_date", _DAY),
            ("eps", _DBL),
            ("bps", _DBL),
            ("roe", _DBL),
            ("roe_waa", _DBL),
            ("profit_yoy", _DBL),
            ("revenue_yoy", _DBL),
            ("free_cashflow", _DBL),
            ("gross_margin", _DBL),
            ("net_margin", _DBL),
            ("dt_debt_ratio", _DBL),
        ]
    ),
    key=("ts_code", "ann_date"),
    partition="ann_year",
    partition_value=year_of("ann_date"),
)

STOCK_NAME_HISTORY = TableSpec(
    "stock_name_history",
    _struct(
        [
            ("ts_code", _STR),
            ("name", _STR),
            ("start_date", _DAY),
            ("end_date", _DAY),
            ("change_reason", _STR),
            ("is_st", _BOOL),
        ]
    ),
    key=("ts_code", "start_date", "name"),
    partition="start_year",
    partition_value=year_of("start_date"),
    insert_defaults={"is_st": False},
)

DATA_SOURCE_AUDIT = TableSpec(
    "data_source_audit",
    _struct(
        [
            ("audit_date", _DAY),
            ("ts_code", _STR),
            ("start_date", _DAY),
            ("end_date", _DAY),
            ("primary_source", _STR),
            ("secondary_source", _STR),
            ("compared_rows", _INT),
            ("max_close_diff_pct", _DBL),
            ("status", _STR),
            ("error_msg", _STR),
        ]
    ),
    key=("audit_date", "ts_code", "primary_source", "secondary_source"),
    partition="audit_month",
    partition_value=month_of("audit_date"),
    insert_defaults={"compared_rows": 0},
)

TRADE_CALENDAR = TableSpec(
    "trade_calendar",
    _struct(
        [
            ("trade_date", _DAY),
            ("is_open", _INT),
            ("pretrade_date", _DAY),
            ("day_of_week", _INT),
            ("week_of_year", _INT),
            ("month", _INT),
            ("year", _INT),
        ]
    ),
    key=("trade_date",),
    partition="cal_year",
    partition_value=year_of("trade_date"),
)

PIPELINE_LOG = TableSpec(
    "pipeline_log",
    _struct(
        [
            ("id", _LONG),
            ("run_date", _DAY),
            ("start_time", _TS),
            ("end_time", _TS),
            ("status", _STR),
            ("stocks_fetched", _INT),
            ("stocks_cleaned", _INT),
            ("error_msg", _STR),
            ("quality_report", _STR),
            ("duration_sec", _DBL),
        ]
    ),
    key=("id",),
    partition="run_year",
    partition_value=year_of("run_date"),
    append_only=True,
)

# One row per instrument about its stored bars: which days and months they span, and the last factor.
BAR_DIRECTORY = TableSpec(
    "bar_directory",
    _struct(
        [
            ("ts_code", _STR),
            ("first_date", _DAY),
            ("latest_date", _DAY),
            ("last_factor", _DBL),
            ("months", ArrayType(_STR)),
        ]
    ),
    key=("ts_code",),
    partition="market",
    partition_value=lambda: market_of("ts_code"),
)

TABLES = {
    spec.name: spec
    for spec in (
        STOCK_LIST,
        DAILY_KLINE,
        DAILY_BASIC,
        FINANCIAL_INDICATORS,
        STOCK_NAME_HISTORY,
        DATA_SOURCE_AUDIT,
        TRADE_CALENDAR,
        PIPELINE_LOG,
    )
}


def require_columns(frame_columns: list[str], needed: tuple[str, ...] | list[str], what: str) -> None:
    missing = [c for c in needed if c not in frame_columns]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}")
