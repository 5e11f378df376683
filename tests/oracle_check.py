"""Run a query in both engines and compare whole results, columns by name, rows in any order."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted([tuple(_plain(r[i]) for i in order) for r in rows])


def spark_result(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def oracle_result(connection, sql):
    cursor = connection.execute(sql)
    return _rows([c[0] for c in cursor.description], cursor.fetchall())
