"""Connected components of a graph given as edges between longs.

Every task first contracts its own edges to a forest, so that at most one edge
a node and task is shuffled. Then large-star and small-star steps alternate
(Kiveris et al., "Connected components in MapReduce and beyond"): each is one
aggregation and one join, and the number of rounds grows with the logarithm of
a component's size. A round is one job: its edges are kept in the shared
checkpoint folder, and what tells whether they changed is observed on the way.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from textgauge.llm.common import saved

#: Edges that a task contracts at a time.
HELD = 1 << 21


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node that is not the smallest of its component, and the smallest."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    root, x, y = np.arange(len(nodes)), at[: len(a)], at[len(a) :]
    while True:
        x, y = root[x], root[y]
        apart = x != y
        if not apart.any():
            break
        x, y = x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := root[root], root):
            root = up
    other = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[other], nodes[root[other]]


def contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's edges (a, b) as a forest."""
    held, size = [], 0
    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        size += batch.num_rows
        if size >= HELD:
            a, b = forest(*map(np.concatenate, zip(*held)))
            if len(a) > HELD // 2:  # contracting again would not pay
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                held, size = [], 0
            else:
                held, size = [(a, b)], len(a)
    if held:
        a, b = forest(*map(np.concatenate, zip(*held)))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    others = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).unionByName(others).where("a <> b").distinct()


def forget(df: DataFrame) -> None:
    """Let Spark's cleaner remove the shuffles and checkpoints of earlier rounds, which nothing refers to."""
    gc.collect()
    df.sparkSession._jvm.System.gc()


def _kept(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, saved, with their number and a sum over them."""
    seen = Observation()
    made = saved(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("sum")))
    return made, (seen.get["n"], seen.get["sum"])


def components(edges: DataFrame, forests: bool = False) -> DataFrame:
    """(node, root) of every node but the roots; a root is its component's smallest node.

    ``forests``: a task's edges are ``contracted`` already by the function that
    makes them. Done here, that takes a second Python worker beside each of its own.
    """
    edges = edges.select("a", "b").where("a <> b")
    edges, mark = _kept(edges if forests else edges.mapInArrow(contracted, "a long, b long"))
    while mark[0]:
        edges, now = _kept(_small_star(_large_star(edges)))
        forget(edges)
        if now == mark:
            break
        mark = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
