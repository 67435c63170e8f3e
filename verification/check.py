"""Compare Spark queries with their SQL: ``python -m verification.check SF_DIR [NAME ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

from barlake.session import build_session
from verification.oracle import oracle
from verification.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def cell(value: object) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, bool) or type(value).__name__ in ("bool_", "bool"):
        return str(bool(value))
    if isinstance(value, float):
        return repr(value + 0.0) if value else "0.0"
    return str(value)


def rows(columns: list[str], data: list[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in data)


# Spark and SQL names of the types the queries return
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def compare(spark, con, sf_dir: str, name: str) -> tuple[str, int, float, float]:
    begin = time.time()
    frame = QUERIES[name](spark, sf_dir)
    got = rows(frame.columns, [tuple(r) for r in frame.collect()])
    took = time.time() - begin
    sql = oracle().get(name)
    if sql is None:
        return "rows-only", len(got), took, 0.0
    begin = time.time()
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    expected = rows(columns, result.fetchall())
    sql_took = time.time() - begin
    if sorted(columns) != sorted(frame.columns):
        return f"COLUMNS {sorted(frame.columns)} <> {sorted(columns)}", len(got), took, sql_took
    types = {c: TYPES.get(t, t) for c, t in frame.dtypes}
    sql_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    if types != sql_types:
        return f"TYPES {types} <> {sql_types}", len(got), took, sql_took
    if got != expected:
        only = [r for r in got if r not in set(expected)][:3], [r for r in expected if r not in set(got)][:3]
        return f"DIFF rows {len(got)} <> {len(expected)}\n   spark {only[0]}\n   sql   {only[1]}", len(got), took, sql_took
    return "ok", len(got), took, sql_took


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = build_session(
        master="local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names:
        try:
            verdict, n, took, sql_took = compare(spark, con, sf_dir, name)
        except Exception as error:  # one broken query must not hide the others
            verdict, n, took, sql_took = f"ERROR {type(error).__name__} {str(error)[:600]}", 0, 0.0, 0.0
        bad += verdict not in ("ok", "rows-only")
        print(f"{name:28s} {n:7d} {took:6.2f}s {sql_took:6.2f}s {verdict}", flush=True)
    print(f"{len(names) - bad}/{len(names)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
