"""Raw files to base tables, and base tables to their stored layout."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexledger import schemas
from hexledger.operators import joins, quality, rows, sets, spatial
from hexledger.sources import catalog, readers, writers

TX_NATURAL_KEY = ["customer_id", "h3_09", "datetime_id", "mcc_code"]


def prepare(
    spark: SparkSession,
    id_lists: list[str],
    transactions: str,
    withdrawals: str,
    poi: str,
    cells: DataFrame,
    grid_step: float = 0.002,
) -> dict[str, DataFrame]:
    """The four base tables from the raw files.

    `cells` (h3_09, lat, lon) is the cell dimension that gives the centre of every listed id.
    A place gets the square-grid key of its own position, in a column of its own, and the nearest listed cell
    as its cell and its centre.
    """
    locations = sets.union_distinct(*[readers.read_id_list(spark, path, cells) for path in id_lists])
    places = rows.not_null(readers.read_parquet(spark, poi), "tags")
    places = places.withColumn("grid_key", spatial.square_grid_key(F.col("lat"), F.col("lon"), grid_step))
    places = spatial.nearest_site(places, locations, "h3_09", name="h3_09_center").drop("nearest_distance")
    places = places.withColumn("h3_09", F.col("h3_09_center"))
    return {
        "locations": locations,
        "transactions": rows.surrogate_key(readers.read_parquet(spark, transactions), TX_NATURAL_KEY),
        "cash_withdrawals": readers.read_parquet(spark, withdrawals),
        "poi": places,
    }


def constraint_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, kind, columns, violations) for every declared key, reference and not-null column.

    Rows of a repeated key count once a key, missing references once a value, nulls once a row.
    """
    found = []
    for name, keys in schemas.PRIMARY_KEYS.items():
        counted = quality.pk_violations(tables[name], keys).agg(F.count("*").alias("violations"))
        found.append(counted.select(F.lit(name).alias("table_name"), F.lit("key").alias("kind"),
                                    F.lit(",".join(keys)).alias("columns"), "violations"))
    for name, column, target, key in schemas.FOREIGN_KEYS:
        missing = joins.missing_values(tables[name], tables[target], column, key)
        counted = missing.agg(F.count("*").alias("violations"))
        found.append(counted.select(F.lit(name).alias("table_name"), F.lit("reference").alias("kind"),
                                    F.lit(column).alias("columns"), "violations"))
    for name, schema in schemas.BASE_TABLES.items():
        required = [f.name for f in schema.fields if not f.nullable]
        counted = quality.null_counts(tables[name], required)
        found.append(counted.select(F.lit(name).alias("table_name"), F.lit("not null").alias("kind"),
                                    F.col("column_name").alias("columns"), F.col("null_count").alias("violations")))
    return reduce(lambda a, b: a.unionByName(b), found)


def store(tables: dict[str, DataFrame], database: str, location: str) -> None:
    """Recreate the database: ORC tables, transactions partitioned, withdrawals bucketed."""
    spark = next(iter(tables.values())).sparkSession
    catalog.recreate_database(spark, database, location)
    for name in ("locations", "poi"):
        writers.rewrite_orc(tables[name], f"{database}.{name}", f"{location}/{name}")
    target = f"{location}/transactions"
    name = f"{database}.transactions"
    writers.write_partitioned(tables["transactions"], target, ["datetime_id", "mcc_code"], table=name)
    writers.write_bucketed(
        tables["cash_withdrawals"], f"{database}.cash_withdrawals", f"{location}/cash_withdrawals", "customer_id"
    )
