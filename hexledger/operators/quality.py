"""Data-quality checks: keys, nulls, zeros, the rule on missing deviations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def melt(aggregated: DataFrame, columns: list[str], value_name: str) -> DataFrame:
    """One row with a column per name, as (column_name, value) rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias(value_name)) for c in columns])
    return aggregated.select(F.inline(pairs))


def _count_per_column(df: DataFrame, columns: list[str], test, value_name: str) -> DataFrame:
    counted = df.agg(*[F.count_if(test(F.col(f"`{c}`"))).alias(c) for c in columns])
    return melt(counted, columns, value_name)


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return _count_per_column(df, columns or df.columns, Column.isNull, "null_count")


def zero_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return _count_per_column(df, columns, lambda c: c == 0, "zero_count")


def distinct_counts(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """Different non-null values per column: exact, or a sketch when `approximate` is asked for."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return melt(df.agg(*[count(F.col(f"`{c}`")).alias(c) for c in columns]), columns, "distinct_count")


def not_null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns that should hold no null but do."""
    return null_counts(df, columns).filter("null_count > 0")


def pk_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def std_null_violations(df: DataFrame) -> DataFrame:
    """Rows where a missing deviation and a single operation do not go together."""
    return df.filter(F.col("std").isNull() != (F.col("count") == 1))
