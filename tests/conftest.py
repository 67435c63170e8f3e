from __future__ import annotations

import datetime as dt
import os
import sys
from collections.abc import Callable
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

from barlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def d(text: str | None) -> dt.date | None:
    return dt.date.fromisoformat(text) if text else None


@pytest.fixture
def frame(spark) -> Callable[[str, list[tuple]], DataFrame]:
    """``frame("a STRING, day DATE", rows)``; ISO strings in DATE columns become dates."""

    def make(schema: str, rows: list[tuple]) -> DataFrame:
        kinds = [part.strip().split()[-1].upper() for part in schema.split(",")]
        fixed = [
            tuple(d(v) if kind == "DATE" and isinstance(v, str) else v for kind, v in zip(kinds, row)) for row in rows
        ]
        return spark.createDataFrame(fixed, schema)

    return make


BAR = "ts_code STRING, trade_date DATE, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, vol DOUBLE, amount DOUBLE"


@pytest.fixture
def bars(frame):
    return lambda rows: frame(BAR, rows)


def by_key(df: DataFrame, *keys: str) -> dict:
    keys = keys or ("ts_code", "trade_date")
    return {tuple(str(r[k]) for k in keys): r for r in df.collect()}
