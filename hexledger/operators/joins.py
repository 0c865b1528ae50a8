"""Joins. Dimension sides carry no broadcast hint: Spark broadcasts them only when their size,
estimated or seen at run time, is under its threshold, and splits skewed partitions otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach(df: DataFrame, other: DataFrame, on: str | list[str]) -> DataFrame:
    """Left outer equi-join: every row of `df` is kept."""
    return df.join(other, on, "left")


def matched(df: DataFrame, *others: tuple[DataFrame, str | list[str]]) -> DataFrame:
    """A chain of inner equi-joins."""
    for other, on in others:
        df = df.join(other, on, "inner")
    return df


def attach_with_suffixes(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str = "left",
    suffixes: tuple[str, str] = ("_x", "_y"),
) -> DataFrame:
    """Join on one key; other columns named alike on both sides get a suffix each."""
    clash = (set(left.columns) & set(right.columns)) - {on}

    def renamed(df: DataFrame, suffix: str) -> DataFrame:
        return df.withColumnsRenamed({c: c + suffix for c in df.columns if c in clash})

    return renamed(left, suffixes[0]).join(renamed(right, suffixes[1]), on, how)


def only_top_keys(df: DataFrame, key: str, k: int) -> DataFrame:
    """Rows whose key is among the `k` most frequent (ties: smallest key first)."""
    top = df.groupBy(key).agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), F.asc(key)).limit(k)
    return df.join(F.broadcast(top.select(key)), key, "left_semi")


def pair_predictions(lon: DataFrame, lat: DataFrame, keys: list[str], carried: list[str]) -> DataFrame:
    """One row per key with true and predicted longitude and latitude."""
    left = lon.select(*keys, F.col("lon").alias("true_lon"), F.col("prediction").alias("predicted_lon"), *carried)
    right = lat.select(*keys, F.col("lat").alias("true_lat"), F.col("prediction").alias("predicted_lat"))
    return left.join(right, keys)


def missing_values(source: DataFrame, target: DataFrame, on: str, target_on: str | None = None) -> DataFrame:
    """Distinct non-null values of `source` that `target` lacks; both sides are reduced first."""
    have = source.select(F.col(on).alias("value")).filter("value IS NOT NULL").distinct()
    known = target.select(F.col(target_on or on).alias("value")).distinct()
    return have.join(known, "value", "left_anti")


def inclusion_check(source: DataFrame, target: DataFrame, on: str, target_on: str | None = None) -> DataFrame:
    """One row `included`: all values of `source` occur in `target`, and nulls only if it has nulls."""
    target_on = target_on or on
    facts = (
        missing_values(source, target, on, target_on)
        .select(F.lit(1).alias("missing"), F.lit(0).alias("source_null"), F.lit(0).alias("target_null"))
        .unionByName(
            source.filter(F.col(on).isNull()).select(
                F.lit(0).alias("missing"), F.lit(1).alias("source_null"), F.lit(0).alias("target_null")
            )
        )
        .unionByName(
            target.filter(F.col(target_on).isNull()).select(
                F.lit(0).alias("missing"), F.lit(0).alias("source_null"), F.lit(1).alias("target_null")
            )
        )
    )

    def none(c: str):
        return F.coalesce(F.max(c), F.lit(0)) == 0

    return facts.agg((none("missing") & (none("source_null") | ~none("target_null"))).alias("included"))


def fk_violations(child: DataFrame, parent: DataFrame, on: str, parent_on: str | None = None) -> DataFrame:
    """Child key values without a parent, with the number of child rows that carry them."""
    keys = child.filter(F.col(on).isNotNull()).groupBy(F.col(on).alias("value")).agg(F.count("*").alias("rows"))
    known = parent.select(F.col(parent_on or on).alias("value")).distinct()
    return keys.join(known, "value", "left_anti")
