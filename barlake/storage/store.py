"""All tables below one root folder, and the SQL views over them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from barlake.operators.lookups import MONTH
from barlake.operators.runs import fold_run_log
from barlake.operators.universe import research_universe
from barlake.schemas import DAILY_KLINE, PIPELINE_LOG, TABLES, TableSpec
from barlake.storage import versions
from barlake.storage.anchors import read_adjusted
from barlake.storage.tables import init_table, read_table


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def init_store(spark: SparkSession, root: str) -> None:
    """Create the tables that are not there yet."""
    for name, spec in TABLES.items():
        init_table(spark, table_path(root, name), spec)


def _table(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    path = table_path(root, spec.name)
    stored = read_adjusted(spark, path) if spec is DAILY_KLINE else read_table(spark, path, spec)
    return stored if spec.partition == MONTH else stored.select(*spec.columns)


def by_days(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """``rows`` of the table at ``path``, joined with every day of its months.

    The join keeps all rows and adds nothing.  It is there for SQL that names days only: the condition
    reaches the days, and when the query runs, the months they lie in prune the scan.  Days are computed,
    a row each, and so is the size of what is broadcast."""
    snapshot = versions.current(spark, path)
    months = sorted(name.split("=", 1)[1] for name in snapshot.folders) if snapshot else []
    if not months:
        return rows
    first, (year, month) = date.fromisoformat(f"{months[0]}-01"), map(int, months[-1].split("-"))
    last = date(year + month // 12, month % 12 + 1, 1)
    epoch = date(1970, 1, 1)
    days = spark.range((first - epoch).days, (last - epoch).days, numPartitions=1)
    day = F.date_from_unix_date(F.col("id").cast("int"))
    days = days.select(day.alias("trade_date"), F.date_format(day, "yyyy-MM").alias(MONTH))
    return rows.join(F.broadcast(days), ["trade_date", MONTH]).select(*rows.columns)


def open_store(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables, the universe view and the folded run log, also as temporary views.

    ``daily_kline`` has its forward-adjusted prices derived from the last factors.  Tables of bars keep the column ``trade_month`` (``yyyy-MM``), and so does the universe: the lookups
    by day filter it along with the day.  SQL may name the day alone: the views find the months when
    a query runs (see :func:`by_days`).  Frames show the state at their making: open the store again after a write."""
    frames = {name: _table(spark, root, spec) for name, spec in TABLES.items()}
    frames[PIPELINE_LOG.name] = fold_run_log(frames[PIPELINE_LOG.name])
    parts = (frames["stock_list"], frames["stock_name_history"])
    frames["research_daily_universe"] = research_universe(frames["daily_kline"], *parts)
    views = dict(frames)
    for name, spec in TABLES.items():
        if spec.partition == MONTH:
            views[name] = by_days(spark, table_path(root, name), frames[name])
    views["research_daily_universe"] = research_universe(views["daily_kline"], *parts)
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return frames
