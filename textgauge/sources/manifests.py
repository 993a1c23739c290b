"""Run manifests and run tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgauge.operators.runs import MANIFEST_SCHEMA, uri


def read_manifests(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Manifests below a folder, with the file and folder each came from."""
    reader = spark.read.schema(MANIFEST_SCHEMA).option("multiLine", multi_line)
    return reader.json(path).select(
        "*",
        uri(F.col("_metadata.file_path")).alias("manifest_path"),
        uri(F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")).alias("base_dir"),
    )


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of report files, for joining on the path."""
    return spark.read.text(path, wholetext=True).select(
        uri(F.col("_metadata.file_path")).alias("path"), F.col("value").alias("content")
    )
