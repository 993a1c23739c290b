"""File listings and fingerprints."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Up to this size a file's bytes pass through one row, from any store that Spark
# reads. Larger files are streamed, ``CHUNK`` bytes at a time.
MAX_ROW_BYTES = 64 << 20
CHUNK = 4 << 20


def list_files(spark: SparkSession, folder: str, pattern: str = "*.{csv,json}") -> DataFrame:
    """(path, bytes) of the files in a folder, sorted by path; contents unread."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", F.col("length").alias("bytes")).orderBy("path")


def opened(path: str) -> BinaryIO | pa.NativeFile:
    """A listed file as a stream: mounted ones by their path, others by their URI."""
    if path.startswith("file:") or "://" not in path:
        return open("/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path, "rb")
    store, inside = fs.FileSystem.from_uri(quote(path, safe=":/@"))
    return store.open_input_stream(inside)


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, size in zip(batch.column("path").to_pylist(), batch.column("bytes").to_pylist()):
            digest = hashlib.sha256()
            with opened(path) as stream:
                while chunk := stream.read(CHUNK):
                    digest.update(chunk)
            columns = [pa.array([path]), pa.array([size], pa.int64()), pa.array([digest.hexdigest()])]
            yield pa.RecordBatch.from_arrays(columns, ["path", "bytes", "sha256"])


def file_fingerprints(
    spark: SparkSession, folder: str, pattern: str = "*.{csv,json}", max_row_bytes: int = MAX_ROW_BYTES
) -> DataFrame:
    """SHA-256 of the raw bytes of each file, of any size.

    A digest of one file is sequential, so a large file is one task that holds
    one chunk; files are spread over tasks by their path. Spark lists no empty
    files.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(folder)
    )
    size = F.col("length").alias("bytes")
    small = files.where(F.col("length") <= max_row_bytes).select("path", size, F.sha2("content", 256).alias("sha256"))
    large = files.where(F.col("length") > max_row_bytes).select("path", size).repartition("path")
    return small.unionByName(large.mapInArrow(_streamed, "path string, bytes long, sha256 string")).orderBy("path")
