"""Relational databases through Spark's JDBC source, read in parallel over a numeric column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexledger.sources.writers import write_files


def read_query(spark: SparkSession, url: str, query: str, properties: dict[str, str] | None = None) -> DataFrame:
    """The result of one query; errors of the database are raised."""
    return spark.read.format("jdbc").options(url=url, query=query, **(properties or {})).load()


def list_base_tables(
    spark: SparkSession, url: str, schema: str = "public", properties: dict[str, str] | None = None
) -> DataFrame:
    tables = spark.read.format("jdbc").options(url=url, dbtable="information_schema.tables", **(properties or {}))
    return (
        tables.load()
        .filter((F.col("table_schema") == schema) & (F.col("table_type") == "BASE TABLE"))
        .select("table_name")
    )


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    column: str | None = None,
    num_partitions: int = 1,
    properties: dict[str, str] | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """One table. With a numeric `column` the read is cut into `num_partitions` ranges.

    The range bounds come from the database's own minimum and maximum; they only shape the ranges,
    rows outside and rows with a null key are still read.
    """
    props = {"fetchsize": str(fetch_size), **(properties or {})}
    if column is None or num_partitions <= 1:
        return spark.read.jdbc(url, table, properties=props)
    bounds = read_query(
        spark, url, f"SELECT min({column}) AS lo, max({column}) AS hi FROM {table}", properties
    ).first()
    if bounds[0] is None:
        return spark.read.jdbc(url, table, properties=props)
    return spark.read.jdbc(
        url,
        table,
        column=column,
        lowerBound=int(bounds[0]),
        upperBound=int(bounds[1]) + 1,
        numPartitions=num_partitions,
        properties=props,
    )


def import_tables(
    spark: SparkSession,
    url: str,
    keys: dict[str, str | None],
    target: str,
    num_partitions: int = 8,
    fmt: str = "parquet",
    codec: str = "gzip",
    properties: dict[str, str] | None = None,
) -> None:
    """Copy every table of `keys` (name to partitioning column) to compressed files."""
    for table, column in keys.items():
        df = read_jdbc_table(spark, url, table, column, num_partitions, properties)
        write_files(df, f"{target}/{table}", fmt, codec)


def write_jdbc_table(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    connections: int = 8,
    batch_size: int = 10_000,
    properties: dict[str, str] | None = None,
) -> None:
    """Load a frame; `numPartitions` bounds the number of concurrent connections."""
    options = {"batchsize": str(batch_size), "numPartitions": str(connections), **(properties or {})}
    df.write.format("jdbc").mode(mode).options(url=url, dbtable=table, **options).save()
