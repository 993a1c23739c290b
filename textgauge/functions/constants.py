"""Constant tables inside expressions, written as SQL text.

One parsed expression stands in for hundreds of calls into the JVM, which for
a lexicon or a template list would take longer than a small query itself.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_value(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return f"CAST('{value!r}' AS DOUBLE)"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def sql_list(values: Iterable[object]) -> str:
    return ", ".join(sql_value(v) for v in values)


def array_of(values: Iterable[object], element: str = "string") -> Column:
    """A constant array; typed also when empty."""
    return F.expr(f"CAST(array({sql_list(values)}) AS array<{element}>)")


def rows_of(rows: Iterable[Sequence[object]], *fields: str) -> Column:
    """A constant array of structs."""
    structs = [
        "struct(" + ", ".join(f"{sql_value(v)} AS `{f}`" for f, v in zip(fields, row)) + ")" for row in rows
    ]
    return F.expr(f"array({', '.join(structs)})")
