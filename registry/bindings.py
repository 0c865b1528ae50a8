"""The library's tables, defined over the given test tables, in Spark and as SQL text.

A supplier is a cell, a customer a customer, a part a point of interest, and line items grouped by
(cell, customer, quarter, part group) are the pre-aggregated transactions. Amounts are rounded to
whole units, so that sums are exact in any order.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hexledger.functions import cells
from hexledger.plans.reports import named_places
from hexledger.session import scratch_path, tasks_for

# A resolution-9 id with base cell 8: nine base-7 digits of the key, unused digits 7.
_ID_LEVELS = 9
_ID_BASE = (1 << 59) | (9 << 52) | (8 << 45) | ((1 << 18) - 1)

LAT = "55.7e0 + (({k} * 7919) % 100003) / 1000030.0e0"
LON = "37.5e0 + (({k} * 104729) % 100019) / 1000190.0e0"
POI_LAT = "55.7e0 + (({k} * 15485863) % 1000003) / 10000030.0e0"
POI_LON = "37.5e0 + (({k} * 32452843) % 1000033) / 10000330.0e0"


def _digits(key: str, divide: str, shift: str) -> str:
    return " + ".join(
        shift.format(
            digit=divide.format(key=key, by=7 ** (_ID_LEVELS - level)), by=3 * (cells.MAX_RESOLUTION - level)
        )
        for level in range(1, _ID_LEVELS + 1)
    )


def cell_id(key: str) -> Column:
    digits = _digits(key, "(({key} div {by}) % 7)", "shiftleft({digit}, {by})")
    return F.expr(f"lower(hex({_ID_BASE}L + {digits}))")


def cell_id_sql(key: str) -> str:
    digits = _digits(key, "(({key} // {by}) % 7)", "({digit} << {by})")
    return f"format('{{:x}}', {_ID_BASE}::bigint + {digits})"


SQL_VIEWS = {
    "tx": f"""
        SELECT {cell_id_sql('l_suppkey')} AS h3_09, customer_id, datetime_id, "count", "sum",
               "sum" / "count" AS "avg", "min", "max", std, count_distinct, mcc_code
        FROM (SELECT l_suppkey, o_custkey AS customer_id,
                     CAST(quarter(l_shipdate) - 1 AS smallint) AS datetime_id,
                     CAST(count(*) AS smallint) AS "count",
                     sum(round(l_extendedprice)) AS "sum",
                     min(round(l_extendedprice)) AS "min", max(round(l_extendedprice)) AS "max",
                     round(stddev_samp(round(l_extendedprice)), 4) AS std,
                     CAST(count(DISTINCT l_partkey) AS smallint) AS count_distinct,
                     CAST(l_partkey % 3 AS smallint) AS mcc_code
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey
              GROUP BY l_suppkey, o_custkey, quarter(l_shipdate), l_partkey % 3)""",
    "withdrawals": f"""
        SELECT DISTINCT o_custkey AS customer_id, {cell_id_sql('l_suppkey')} AS h3_09
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE l_returnflag = 'R' AND l_quantity < 10""",
    "locations": f"""
        SELECT {cell_id_sql('s_suppkey')} AS h3_09, {LAT.format(k='s_suppkey')} AS lat,
               {LON.format(k='s_suppkey')} AS lon FROM supplier""",
    "atm": f"""
        SELECT {cell_id_sql('s_suppkey')} AS h3_09, {LAT.format(k='s_suppkey')} AS lat,
               {LON.format(k='s_suppkey')} AS lon FROM supplier WHERE s_acctbal < 3000""",
    "poi": f"""
        SELECT p_partkey AS id,
               CASE WHEN p_size % 7 = 0 THEN NULL
                    WHEN p_size % 2 = 0 THEN concat('[(''name'', ''', p_name, ''')]')
                    ELSE concat('[(''brand'', ''', p_brand, '''), (''name'', ''', p_name,
                                '''), (''operator'', "O''Neil"), (''type'', ''', p_type, ''')]') END AS tags,
               {POI_LAT.format(k='p_partkey')} AS lat, {POI_LON.format(k='p_partkey')} AS lon,
               {cell_id_sql('(p_partkey // 20)')} AS h3_09_center
        FROM part""",
    # The published rule keeps a name only where it is the single tag.
    "places": """
        SELECT p_partkey AS id, h3_09_center, lat, lon, lower(trim(p_name)) AS place_name
        FROM poi JOIN part ON id = p_partkey WHERE p_size % 7 <> 0 AND p_size % 2 = 0 AND trim(p_name) <> ''""",
    "cell_tags": """
        SELECT h3_09_center AS h3_09, count(*) || ':' || sum(('0x' || substr(md5(place_name), 1, 15))::BIGINT) AS tags_key
        FROM places GROUP BY h3_09_center""",
    "tx_points": """
        SELECT tx.*, lat, lon FROM tx JOIN locations USING (h3_09)""",
}


# Stored base tables by (application, directory, table): transactions and withdrawals are derived from
# the line items once per application, as an ingest job would, and every query reads the stored rows.
_STORED: dict[tuple[str, str, str], tuple[str, StructType]] = {}


class Tables:
    """The bound tables of one scale directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _STORED:
            df, path = build(), scratch_path(self.spark, name)
            df.write.parquet(path)
            _STORED[key] = path, df.schema
        path, schema = _STORED[key]
        return self.spark.read.schema(schema).parquet(path)

    @property
    def _visits(self) -> DataFrame:
        """Transactions and whether a withdrawal was among their lines: both tables are derived in one pass."""
        return self._stored("visits", self._grouped_lines)

    def _grouped_lines(self) -> DataFrame:
        """Line items joined to their customers and grouped, with one shuffle of narrow rows for each.

        Nearly every line is a group of its own, so partial results would be wider than the rows and no fewer. The
        rows are dealt by the group instead, to as many tasks as they are worth, and aggregated where they are.
        """
        lines = self.raw("lineitem")
        tasks = tasks_for(lines)
        narrow = lines.select(
            "l_orderkey",
            "l_suppkey",
            "l_partkey",
            (F.quarter("l_shipdate") - 1).cast("short").alias("datetime_id"),
            F.round("l_extendedprice").alias("amount"),
            F.expr("l_returnflag = 'R' AND l_quantity < 10").alias("withdrawn"),
        ).repartition(tasks, "l_orderkey")
        orders = self.raw("orders").select("o_orderkey", F.col("o_custkey").alias("customer_id"))
        owned = narrow.join(
            orders.repartition(tasks, "o_orderkey").hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey")
        )
        group = ["l_suppkey", "customer_id", "datetime_id", "mcc_code"]
        dealt = owned.select(
            "l_suppkey",
            "customer_id",
            "datetime_id",
            (F.col("l_partkey") % 3).cast("short").alias("mcc_code"),
            "l_partkey",
            "amount",
            "withdrawn",
        ).repartition(tasks, *group)
        return (
            dealt.groupBy(*group)
            .agg(
                F.count("*").cast("short").alias("count"),
                F.sum("amount").alias("sum"),
                F.min("amount").alias("min"),
                F.max("amount").alias("max"),
                F.round(F.stddev_samp("amount"), 4).alias("std"),
                F.count_distinct("l_partkey").cast("short").alias("count_distinct"),
                F.coalesce(F.bool_or("withdrawn"), F.lit(False)).alias("withdrawn"),
            )
            .withColumn("l_suppkey", cell_id("l_suppkey"))
            .withColumnRenamed("l_suppkey", "h3_09")
        )

    @property
    def transactions(self) -> DataFrame:
        return self._visits.select(
            "h3_09",
            "customer_id",
            "datetime_id",
            "count",
            "sum",
            (F.col("sum") / F.col("count")).alias("avg"),
            "min",
            "max",
            "std",
            "count_distinct",
            "mcc_code",
        )

    @property
    def withdrawals(self) -> DataFrame:
        return self._stored("withdrawals", self._withdrawals)

    def _withdrawals(self) -> DataFrame:
        return self._visits.filter("withdrawn").select("customer_id", "h3_09").distinct()

    def _cells(self, suppliers: DataFrame) -> DataFrame:
        return suppliers.select(
            cell_id("s_suppkey").alias("h3_09"),
            F.expr(LAT.format(k="s_suppkey")).alias("lat"),
            F.expr(LON.format(k="s_suppkey")).alias("lon"),
        )

    @cached_property
    def locations(self) -> DataFrame:
        return self._cells(self.raw("supplier"))

    @cached_property
    def atm(self) -> DataFrame:
        return self._cells(self.raw("supplier").filter("s_acctbal < 3000"))

    @cached_property
    def poi(self) -> DataFrame:
        name_pair = F.concat(F.lit("('name', '"), F.col("p_name"), F.lit("')"))
        tags = (
            F.when(F.col("p_size") % 7 == 0, None)
            .when(F.col("p_size") % 2 == 0, F.concat(F.lit("["), name_pair, F.lit("]")))
            .otherwise(
                F.concat(
                    F.lit("[('brand', '"),
                    F.col("p_brand"),
                    F.lit("'), "),
                    name_pair,
                    F.lit(", ('operator', \"O'Neil\"), ('type', '"),
                    F.col("p_type"),
                    F.lit("')]"),
                )
            )
        )
        centre = cell_id("(p_partkey div 20)")
        return self.raw("part").select(
            F.col("p_partkey").alias("id"),
            tags.alias("tags"),
            F.expr(POI_LAT.format(k="p_partkey")).alias("lat"),
            F.expr(POI_LON.format(k="p_partkey")).alias("lon"),
            centre.alias("h3_09"),
            centre.alias("h3_09_center"),
        )

    @cached_property
    def places(self) -> DataFrame:
        return named_places(self.poi)

    @cached_property
    def tx_points(self) -> DataFrame:
        return self.transactions.join(self.locations, "h3_09")
