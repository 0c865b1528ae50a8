"""Row-level operators: filters, projections, null handling, splitting, numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexledger.functions import values
from hexledger.session import materialize

# Fixed value: larger amounts are left out of the training features.
AMOUNT_CAP = 200000

_NUMERIC = (T.NumericType,)


def amount_cap(df: DataFrame, amount: str = "sum", cap: float = AMOUNT_CAP) -> DataFrame:
    """Rows up to the cap, null amounts dropped."""
    return df.filter(F.col(amount) <= cap)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def without_tag(df: DataFrame, text: str, column: str = "tags") -> DataFrame:
    return df.filter(~F.col(column).contains(text))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def select_numeric(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in numeric_columns(df)])


def fill_null_numbers(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """0 for nulls of numeric columns; other columns are untouched."""
    return df.na.fill(0, subset=columns) if columns else df.na.fill(0)


def drop_null_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.drop(subset=columns)


def default_label(df: DataFrame, column: str, label: str) -> DataFrame:
    return df.withColumn(column, values.default_label(F.col(column), label))


def head(df: DataFrame, order: list[str | Column], n: int) -> DataFrame:
    """The first `n` rows by `order` (a bounded heap per task, never a full sort)."""
    return df.orderBy(*order).limit(n)


def key_split(df: DataFrame, keys: list[str], train_percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """(train, test) by the md5 of the key: stable under repartitioning, retries and new runs."""
    share = values.key_share(*[F.col(k) for k in keys])
    return df.filter(share < train_percent), df.filter(share >= train_percent)


def surrogate_key(df: DataFrame, order: list[str], name: str = "transaction_pk") -> DataFrame:
    """0-based consecutive row numbers in the order of `order`, without a single-task window.

    The rows are range-partitioned and sorted, numbered inside their partition, and written once so
    that the numbering is fixed; the start of each partition is then a sum over partition sizes.
    """
    inside = (1 << 33) - 1
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    fixed = materialize(ranged, "surrogate_key")
    part = F.shiftright("_id", 33)
    sizes = fixed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # One row per partition of the range shuffle.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (
        fixed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_id").bitwiseAND(F.lit(inside).cast("long")))
        .drop("_part", "_id", "_start")
    )
