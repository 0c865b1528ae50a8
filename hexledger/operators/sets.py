"""Distinct, union, duplicates, top-k."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_distinct(*frames: DataFrame) -> DataFrame:
    """All rows by column name, full-row duplicates removed."""
    return reduce(lambda a, b: a.unionByName(b), frames).dropDuplicates()


def duplicate_groups(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    keys = columns or df.columns
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def has_duplicates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: whether any row occurs twice."""
    return duplicate_groups(df, columns).agg((F.count("*") > 0).alias("has_duplicates"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def top_k(df: DataFrame, metric: str, ties: list[str], k: int) -> DataFrame:
    """The `k` largest rows by `metric`, ties in ascending order of `ties`."""
    return df.orderBy(F.col(metric).desc(), *[F.col(t).asc() for t in ties]).limit(k)


def best_per_group(df: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group by `order`.

    Spark keeps one candidate per group and task before the shuffle, so a large group costs no more
    than a small one.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
