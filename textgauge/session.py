"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Temporary folders of local sessions, by application id.
_local_folders: dict[str, str] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and benchmarks; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("textgauge")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster such
    a folder would exist on one machine and vanish with it.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="textgauge-")
    return _local_folders[application]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage durably: a lost executor costs a re-read, not a recomputation.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits(df: DataFrame, bound: int) -> bool:
    """Whether a table has at most ``bound`` rows; reads one row more at most."""
    return df.limit(bound + 1).count() <= bound


def small_side(df: DataFrame, bound: int, label: str) -> DataFrame:
    """A join side that is broadcast when it has at most ``bound`` rows.

    The side is written first, so that counting does not compute it again.
    """
    written = materialise(df, label)
    return F.broadcast(written) if fits(written, bound) else written


def once(df: DataFrame, **columns) -> DataFrame:
    """Append columns that are evaluated exactly once per row.

    A plain projection can be inlined into every later expression and pushed
    predicate that mentions it. A one-element ``inline`` stops that without a
    shuffle, which matters when the expression tokenises a whole text.
    """
    fields = [expression.alias(name) for name, expression in columns.items()]
    return df.select("*", F.inline(F.array(F.struct(*fields))))
