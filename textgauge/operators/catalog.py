"""Dataset catalogs: profiles, fingerprints and freshness."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgauge.functions.hashing import row_digest


def profile(df: DataFrame, path: str, fmt: str, fingerprint: bool = True) -> DataFrame:
    """One row: path, format, rows, columns and an order-free content digest.

    The digest is a sum over rows, so it needs one partial sum per task and
    does not depend on file layout. Without it only the row count is read.
    """
    content = [F.coalesce(F.sum(row_digest(df.columns)), F.lit(0)).cast("string").alias("digest")] if fingerprint else []
    return df.agg(F.count(F.lit(1)).alias("rows"), *content).select(
        F.lit(path).alias("path"),
        F.lit(fmt).alias("format"),
        "rows",
        F.lit(list(df.columns)).alias("columns"),
        *(["digest"] if fingerprint else []),
    )


def profiles(tables: Mapping[str, DataFrame], fmt: str = "parquet", fingerprint: bool = True) -> DataFrame:
    """The catalog of several tables, one row each."""
    rows = [profile(df, path, fmt, fingerprint) for path, df in sorted(tables.items())]
    return reduce(DataFrame.unionByName, rows)


def label_count_map(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Label counts as one map, for a column with few distinct values."""
    counts = df.groupBy(F.col(label_col).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "n")))).alias("label_counts"))


def freshness(current: DataFrame, stored: DataFrame) -> DataFrame:
    """Entries that a stored catalog lacks, still lists, or holds differently."""
    facts = [c for c in current.columns if c != "path" and c in stored.columns]
    c, s = current.alias("c"), stored.alias("s")
    differs = reduce(lambda a, b: a | b, [~F.col(f"c.{f}").eqNullSafe(F.col(f"s.{f}")) for f in facts], F.lit(False))
    state = (
        F.when(F.col("s.path").isNull(), "added")
        .when(F.col("c.path").isNull(), "removed")
        .when(differs, "changed")
    )
    joined = c.join(s, F.col("c.path") == F.col("s.path"), "full_outer")
    return joined.select(F.coalesce("c.path", "s.path").alias("path"), state.alias("state")).where("state is not null")


def require_fresh(current: DataFrame, stored: DataFrame) -> None:
    """Raise when a stored catalog is stale."""
    stale = freshness(current, stored).first()
    if stale:
        raise ValueError(f"Dataset catalog is stale: {stale.path} was {stale.state}")
