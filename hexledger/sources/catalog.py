"""Catalog steps: databases, tables, descriptions, previews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def recreate_database(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{location}'")


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}").select("namespace", "tableName", "isTemporary")


def describe_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE FORMATTED {table}")


def preview(spark: SparkSession, table: str, order: list[str], rows: int = 5) -> DataFrame:
    """The first rows by `order`, so the preview is the same on every run."""
    return spark.table(table).orderBy(*order).limit(rows)
