"""Scans, sinks and layouts: write to the shared folder, read back, compare."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from hexledger.operators import aggregates, joins, rows
from hexledger.plans.reports import TOP_CELLS
from hexledger.session import scratch_path
from hexledger.sources import catalog, prepared, readers, writers
from registry.core import query
from registry.join_queries import CENTROID_SQL, centroid_predictions

TX_ALL_SQL = (
    'SELECT h3_09, customer_id, datetime_id, "count", "sum", "avg", "min", "max", std, count_distinct, mcc_code FROM tx'
)


def _table(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:12]}"


@query("scan_parquet", "SELECT * REPLACE (strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts) FROM events")
def _(t):
    events = readers.read_parquet(t.spark, f"{t.sf_dir}/events.parquet")
    return events.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query("scan_id_list", "SELECT h3_09, lat, lon FROM (SELECT DISTINCT h3_09 FROM tx) JOIN locations USING (h3_09)")
def _(t):
    path = scratch_path(t.spark, "ids")
    ids = t.transactions.select("h3_09").distinct()
    ids.select(F.concat(F.lit(" "), "h3_09", F.lit("  "))).write.text(path)
    return readers.read_id_list(t.spark, path, t.locations)


@query("scan_table", "SELECT h3_09, lat, lon FROM locations")
def _(t):
    name = _table("locations")
    t.locations.write.option("path", scratch_path(t.spark, "table")).saveAsTable(name)
    return readers.read_table(t.spark, name)


@query("scan_json", TX_ALL_SQL)
def _(t):
    path = scratch_path(t.spark, "json")
    writers.write_json_lines(t.transactions, path)
    return readers.read_json_lines(t.spark, path, t.transactions.schema)


@query("sink_json", "SELECT id, tags, lat, lon FROM poi")
def _(t):
    path = scratch_path(t.spark, "json")
    poi = t.poi.select("id", "tags", "lat", "lon")
    writers.write_json_lines(poi, path)
    return readers.read_json_lines(t.spark, path, poi.schema)


@query("scan_csv", TX_ALL_SQL)
def _(t):
    path = scratch_path(t.spark, "csv")
    writers.write_csv(t.transactions, path)
    return readers.read_csv(t.spark, path, t.transactions.schema)


@query("sink_csv", "SELECT customer_id, h3_09 FROM withdrawals")
def _(t):
    path = scratch_path(t.spark, "csv")
    writers.write_csv(t.withdrawals, path)
    return readers.read_csv(t.spark, path, t.withdrawals.schema)


@query(
    "sink_delimited",
    "SELECT id, tags FROM poi WHERE tags IS NOT NULL",
)
def _(t):
    path = scratch_path(t.spark, "delimited")
    poi = t.poi.filter("tags IS NOT NULL").select("id", "tags")
    writers.write_delimited(poi, path)
    return t.spark.read.schema(poi.schema).option("escape", '"').csv(path)


@query("path_count", "SELECT count(*) AS row_count FROM lineitem")
def _(t):
    return readers.path_count(t.spark, f"{t.sf_dir}/lineitem.parquet")


@query(
    "load_or_build",
    """SELECT part, count(*) AS n, count(DISTINCT h3_09) AS n_cells FROM (
           SELECT h3_09, CASE WHEN CAST('0x' || substr(md5(concat_ws('|', CAST(customer_id AS varchar), h3_09)), 1, 8)
                  AS bigint) % 100 < 80 THEN 'train' ELSE 'test' END AS part FROM withdrawals) GROUP BY part""",
)
def _(t):
    path = scratch_path(t.spark, "split")

    def split():
        return rows.key_split(t.withdrawals, ["customer_id", "h3_09"])

    def must_not_run():
        raise AssertionError("the stored split was not used")

    prepared.load_or_build(t.spark, path, split)
    train, test = prepared.load_or_build(t.spark, path, must_not_run)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part").agg(F.count("*").alias("n"), F.count_distinct("h3_09").alias("n_cells"))


@query("rewrite_orc", TX_ALL_SQL)
def _(t):
    name = _table("transactions")
    writers.rewrite_orc(t.transactions, name, scratch_path(t.spark, "orc"))
    return t.spark.table(name)


@query(
    "write_partitioned",
    """SELECT datetime_id, mcc_code, 'smallint' AS kind, count(*) AS n, sum("sum") AS total FROM tx
       GROUP BY datetime_id, mcc_code""",
)
def _(t):
    name = _table("partitioned")
    writers.write_partitioned(
        t.transactions, scratch_path(t.spark, "partitioned"), ["datetime_id", "mcc_code"], table=name
    )
    stored = t.spark.table(name)
    return stored.groupBy("datetime_id", "mcc_code", F.typeof("mcc_code").alias("kind")).agg(
        F.count("*").alias("n"), F.sum("sum").alias("total")
    )


@query("write_bucketed", "SELECT customer_id, h3_09 FROM withdrawals")
def _(t):
    name = _table("withdrawals")
    writers.write_bucketed(t.withdrawals, name, scratch_path(t.spark, "bucketed"), "customer_id")
    return t.spark.table(name)


@query(
    "write_codec",
    """SELECT t."table", f.format, f.codec, CASE WHEN f.codec = 'Bzip2' THEN 'FAILED' ELSE 'OK' END AS status,
              CASE WHEN f.codec <> 'Bzip2' THEN t.n END AS rows
       FROM (SELECT 'locations' AS "table", count(*) AS n FROM locations
             UNION ALL SELECT 'withdrawals', count(*) FROM withdrawals
             UNION ALL SELECT 'transactions', count(*) FROM tx UNION ALL SELECT 'poi', count(*) FROM poi) t,
            (VALUES ('parquet', 'Gzip'), ('parquet', 'Snappy'), ('parquet', 'Bzip2'),
                    ('orc', 'Gzip'), ('orc', 'Snappy'), ('orc', 'Bzip2')) f(format, codec)""",
)
def _(t):
    tables = {"locations": t.locations, "withdrawals": t.withdrawals, "transactions": t.transactions, "poi": t.poi}
    trial = writers.storage_trial(tables, scratch_path(t.spark, "codecs"), formats=("parquet", "orc"))
    return trial.select("table", "format", "codec", "status", "rows")


@query(
    "export_report",
    f"""SELECT h3_09, CAST(total AS decimal(15,2)) AS total_sum, lat, lon
        FROM (SELECT h3_09, round(sum("sum"), 2) AS total FROM tx GROUP BY h3_09) JOIN locations USING (h3_09)
        ORDER BY total_sum DESC, h3_09 LIMIT {TOP_CELLS}""",
)
def _(t):
    path = scratch_path(t.spark, "report")
    totals = aggregates.cell_totals(t.transactions, t.locations)
    writers.export_report(totals, path, [F.desc("total_sum"), F.asc("h3_09")], TOP_CELLS)
    return readers.read_csv(t.spark, path, totals.schema)


@query("sink_predictions", CENTROID_SQL)
def _(t):
    path = scratch_path(t.spark, "predictions")
    lon, lat = centroid_predictions(t)
    writers.write_predictions(joins.pair_predictions(lon, lat, ["customer_id", "h3_09"], []), path)
    return t.spark.read.parquet(path)


@query(
    "catalog_ops",
    """SELECT 'locations' AS table_name, count(*) AS n_rows, min(h3_09) AS first_id FROM locations
       UNION ALL SELECT 'withdrawals', count(*), min(h3_09) FROM withdrawals""",
)
def _(t):
    database = _table("ledger")
    location = scratch_path(t.spark, "database")
    catalog.recreate_database(t.spark, database, location)
    for name, df in (("locations", t.locations), ("withdrawals", t.withdrawals), ("staging", t.locations)):
        df.write.format("orc").saveAsTable(f"{database}.{name}")
    catalog.drop_table(t.spark, f"{database}.staging")
    names = [r["tableName"] for r in catalog.list_tables(t.spark, database).collect()]
    counted = [
        t.spark.table(f"{database}.{n}")
        .agg(F.count("*").alias("n_rows"), F.min("h3_09").alias("first_id"))
        .withColumn("table_name", F.lit(n))
        for n in names
    ]
    result = counted[0]
    for df in counted[1:]:
        result = result.unionByName(df)
    return result
