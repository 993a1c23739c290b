"""Parquet tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Read ``folder/name.parquet``; how it is split is up to spark.sql.files.*."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
