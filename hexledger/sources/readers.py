"""Scans. Every reader takes an explicit schema where the format does not carry one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, in whatever format the table was stored."""
    return spark.table(name)


def read_json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header; columns are bound by name and a header that disagrees is an error."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_avro(spark: SparkSession, path: str) -> DataFrame:
    """Needs the spark-avro module on the session's class path."""
    return spark.read.format("avro").load(path)


def read_id_list(spark: SparkSession, paths: str | list[str], cells: DataFrame | None = None) -> DataFrame:
    """One cell id per line, trimmed; blank lines are skipped.

    With `cells` (h3_09, lat, lon) the centre of each known cell is attached, unknown ids keep
    null coordinates.
    """
    ids = spark.read.text(paths).select(F.trim("value").alias("h3_09")).filter("h3_09 != ''")
    if cells is None:
        return ids
    return ids.join(cells.select("h3_09", "lat", "lon"), "h3_09", "left")


def path_count(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.sql(f"SELECT count(*) AS row_count FROM {fmt}.`{path}`")
