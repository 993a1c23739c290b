"""What the operators of this subpackage share.

Row keys: results are tied back to rows by ``row_key``, a hash of id and text,
so that null ids and repeated ids with different texts stay apart; equal rows
share a key and get equal results.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Lower-cases A-Z in UTF-8 bytes and leaves all else.
LOWER_BYTES = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())
#: Rows of an Arrow batch: bounds a Python worker's memory at this many texts.
BATCH_ROWS = 500


#: The folder that holds the package.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Let Arrow batches hold few rows, as one row holds a whole text.

    Also lets Python workers import this package from where the driver found it,
    which matters where it is neither installed nor sent with the job.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [path, ROOT]))


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case; other letters stay."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def row_key(*columns: str) -> Column:
    return F.xxhash64(*[F.col(c) for c in columns])


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """All of a row as ``row``, beside own columns whose names then can't clash with it."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(n) for n, c in columns.items()])


def unpacked(df: DataFrame, names: list[str]) -> list[Column]:
    return [F.col("row").getField(n).alias(n) for n in names]


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that all executors share; read from the session.

    Where nothing is set, a local session gets a temporary folder and a cluster
    an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if folder:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
        return folder.rstrip("/")
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir().rsplit("/", 1)[0]


def saved(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder.

    A lost executor costs a re-read. The files go when nothing refers to the
    table any more, if spark.cleaner.referenceTracking.cleanCheckpoints is set.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER_BYTES).split() if text else []


def rows_out(batches: Iterable[pa.RecordBatch], schema: pa.Schema, make) -> Iterator[pa.RecordBatch]:
    """Apply ``make(batch) -> list of columns`` to each batch."""
    for batch in batches:
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, field.type) if not isinstance(column, pa.Array) else column for column, field in zip(make(batch), schema)],
                schema=schema,
            )


def hot_keys(counted: DataFrame, n: str, share: int = 1000) -> DataFrame:
    """Rows of ``counted`` whose ``n`` is at least a thousandth of the sum: 1000 at most."""
    total = counted.agg(F.coalesce(F.sum(n), F.lit(0)).alias("total")).first()["total"]
    return counted.where(F.col(n) * share >= F.lit(max(total, 1)))


def join_hot(rows: DataFrame, counted: DataFrame, on: list[str], n: str, how: str = "left") -> DataFrame:
    """``rows`` joined with ``counted``, which has one row per key and its count ``n``.

    Keys that hold a thousandth of all rows, of which there are 1000 at most,
    are broadcast and so never gather in one task; the others are shuffled.
    Both tables are read more than once: hand over saved ones.
    """
    hot = F.broadcast(hot_keys(counted, n))
    near = rows.join(hot, on, "inner")
    far = rows.join(hot.select(*on), on, "left_anti").join(counted, on, how)
    return near.unionByName(far)
