"""Session building, and the shared folder used for materialised intermediates."""

from __future__ import annotations

import atexit
import contextlib
import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side of a join is sent to every executor only after it was found to hold at most this many rows.
BROADCAST_ROWS = 200_000
# Rows that one task groups: some 30 MB of groups, whatever the size of the table.
ROWS_PER_TASK = 200_000

# Applications whose scratch folder is removed when the driver's process ends.
_CLEANED: set[str] = set()


def build_session(
    app_name: str,
    warehouse: str | None = None,
    master: str | None = None,
    hive: bool = False,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with adaptive execution; the cluster's own settings win for resources."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    if warehouse:
        builder = builder.config("spark.sql.warehouse.dir", warehouse)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: `spark.checkpoint.dir`, else the warehouse.

    A warehouse that was never set lies under the driver's working folder, which executors on other machines
    do not have: there `spark.checkpoint.dir` must name a folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    warehouse, master = spark.conf.get("spark.sql.warehouse.dir"), spark.sparkContext.master
    if warehouse.startswith("file:") and not master.startswith("local"):
        raise ValueError(f"{warehouse} is a folder of one machine: set spark.checkpoint.dir to a shared folder")
    return warehouse


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's own file systems."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _clean(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended before the process
        remove(spark, path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one written intermediate; removed at the end of the application."""
    folder = f"{shared_dir(spark).rstrip('/')}/hexledger/{spark.sparkContext.applicationId}"
    if folder not in _CLEANED:
        _CLEANED.add(folder)
        atexit.register(_clean, spark, folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and continue from the written table.

    Used where a value must not change between two passes (row numbers, partition ids) or where
    several branches would otherwise recompute the same input. Survives executor loss.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, column: str, buckets: int, name: str) -> DataFrame:
    """`df`, best dealt by `column` before, written as a table in buckets by it: later groupings need no shuffle."""
    spark, table = df.sparkSession, f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    writer = df.write.option("path", scratch_path(spark, name))
    writer.bucketBy(buckets, column).saveAsTable(table)
    atexit.register(_forget, spark, table)
    return spark.table(table)


def _forget(spark: SparkSession, table: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended before the process
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def tasks_for(df: DataFrame, rows: int = ROWS_PER_TASK) -> int:
    """How many tasks the rows of `df` are worth, so that a task's share does not grow with the table."""
    return max(1, math.ceil(df.count() / rows))


def counted_side(df: DataFrame, name: str) -> DataFrame:
    """A join side, written and counted: broadcast when it is small, joined by shuffling otherwise.

    For narrow aggregates whose size Spark cannot estimate. Without this, the large side would be
    shuffled before the small one is known to be small.
    """
    stored = materialize(df, name)
    return F.broadcast(stored) if stored.count() <= BROADCAST_ROWS else stored
