"""Small helpers that the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Arrow batches handed to a Python worker; bounds its memory together with text_arrays.SLICE_BYTES.
BATCH_BYTES = 4 << 20

# A side of a join is broadcast only after it was counted to have at most this many narrow rows.
NARROW_ROWS = 1_000_000


def bound_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, so that long documents do not add up to a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def counted(small: DataFrame, rows: int, bound: int = NARROW_ROWS) -> DataFrame:
    """`small`, broadcast if its counted `rows` are within `bound`; else it is joined by shuffling."""
    return F.broadcast(small) if rows <= bound else shuffled(small)


def shuffled(side: DataFrame) -> DataFrame:
    """`side`, never broadcast: Spark would by the size of the files it comes from, however many rows it became."""
    return side.hint("merge")


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def fresh(name: str, *frames: DataFrame) -> str:
    """`name`, lengthened until no column of the frames is called so."""
    taken = {c.lower() for frame in frames for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
