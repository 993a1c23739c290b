"""Compares a query with its SQL, values and all, regardless of row order."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def plain(value: object, digits: int) -> object:
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return repr(value)
    if isinstance(value, (int, float)):
        number = float(value)
        return "nan" if math.isnan(number) else f"{round(number, digits) + 0.0:.{digits}f}"
    return repr(value)


def table_of(columns: list[str], rows: list, digits: int) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(plain(row[i], digits) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(cells)


def differences(df, connection: duckdb.DuckDBPyConnection, sql: str, digits: int = 9) -> list[str]:
    """What differs, in words; empty when the results agree."""
    result = connection.execute(sql)
    expected_columns, expected = table_of([d[0] for d in result.description], result.fetchall(), digits)
    columns, rows = table_of(df.columns, df.collect(), digits)
    if columns != expected_columns:
        return [f"columns {columns} != {expected_columns}"]
    if len(rows) != len(expected):
        left, right = set(rows), set(expected)
        return [f"{len(rows)} rows != {len(expected)}; only here {list(left - right)[:3]}; only there {list(right - left)[:3]}"]
    wrong = [(a, b) for a, b in zip(rows, expected) if a != b]
    return [f"{len(wrong)} rows differ, e.g. {wrong[0]}"] if wrong else []
