"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textgauge.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that must return the same rows."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"registered twice: {name}")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


def spread(df: DataFrame) -> DataFrame:
    """A table read by fewer tasks than the session has cores, dealt out to all of them.

    A file with one row group is one task however long its texts take. Tables of
    many files, as on a cluster, are left as they are read.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents"))


def labelled(spark: SparkSession, sf: str, label: str = "quality") -> DataFrame:
    """Documents with a label."""
    labels = table(spark, sf, "labels").select("doc_id", label)
    return documents(spark, sf).join(labels, "doc_id").withColumnRenamed(label, "label")


def placed(ordered: DataFrame) -> DataFrame:
    """Append ``place``: where each row of a short ordered result stands, from 1.

    The rows are taken in the order they come, so the place shows whether the
    operator ordered them; the result must be small, as a top list is.
    """
    rows = ordered.collect()
    numbered = [(*row, k) for k, row in enumerate(rows, 1)]
    return ordered.sparkSession.createDataFrame(numbered, ordered.schema.add("place", "long"))


def values(rows: list[tuple], *columns: str) -> str:
    """A SQL VALUES list."""

    def literal(value: object) -> str:
        if isinstance(value, str):
            return "'" + value.replace("'", "''") + "'"
        return f"CAST({value!r} AS DOUBLE)" if isinstance(value, float) else str(value)

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"(VALUES {body}) AS v({', '.join(columns)})"
