"""Compare a query's Spark result with its equivalent SQL in DuckDB."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day).isoformat()
    return repr(value)


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_result(frame):
    table = frame.toArrow()
    columns = [c.to_pylist() for c in table.columns]
    return _sorted_rows(table.column_names, list(zip(*columns)) if columns else [])


def duck_result(connection, sql):
    cursor = connection.execute(sql)
    return _sorted_rows([d[0] for d in cursor.description], cursor.fetchall())


def differences(frame, connection, sql) -> str | None:
    names, rows = spark_result(frame)
    expected_names, expected = duck_result(connection, sql)
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows != {len(expected)}"
    wrong = [(a, b) for a, b in zip(rows, expected) if a != b]
    if wrong:
        return f"{len(wrong)} rows differ, first {names}: {wrong[0]}"
    return None
