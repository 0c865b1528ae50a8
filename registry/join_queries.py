"""Joins, references and key checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from hexledger import schemas
from hexledger.operators import aggregates, joins, quality, rows
from hexledger.plans.ingest import TX_NATURAL_KEY, constraint_violations
from registry.core import query

CUSTOMER_SQL = """
    SELECT customer_id, count(*) AS total_transactions, count(mcc_code) AS unique_mcc_count,
           avg("sum") AS avg_transaction_amount, round(stddev_samp("sum"), 4) AS std_transaction_amount,
           max(datetime_id) AS max_time_slot, min(datetime_id) AS min_time_slot
    FROM tx GROUP BY customer_id"""
CUSTOMER_CELL_SQL = """
    SELECT customer_id, h3_09, count(*) AS location_transaction_count, avg("sum") AS location_avg_amount,
           count(mcc_code) AS location_unique_mcc_count
    FROM tx GROUP BY customer_id, h3_09"""


def rounded_std(df):
    return df.withColumn("std_transaction_amount", F.round("std_transaction_amount", 4))


@query("join_left_single", f"SELECT * FROM withdrawals LEFT JOIN ({CUSTOMER_SQL}) USING (customer_id)")
def _(t):
    stats = aggregates.customer_stats(t.transactions).drop("distinct_mcc_count")
    return joins.attach(t.withdrawals, rounded_std(stats), "customer_id")


@query(
    "join_left_composite",
    f"SELECT * FROM withdrawals LEFT JOIN ({CUSTOMER_CELL_SQL}) USING (customer_id, h3_09)",
)
def _(t):
    return joins.attach(t.withdrawals, aggregates.customer_cell_stats(t.transactions), ["customer_id", "h3_09"])


@query(
    "join_left_dims",
    """SELECT h3_09, customer_id, lat, lon, tags_key
       FROM withdrawals LEFT JOIN locations USING (h3_09) LEFT JOIN cell_tags USING (h3_09)""",
)
def _(t):
    with_place = joins.attach(t.withdrawals, t.locations, "h3_09")
    return joins.attach(with_place, aggregates.cell_tag_keys(t.places), "h3_09")


@query(
    "join_inner_chain",
    """SELECT h3_09, customer_id, datetime_id, mcc_code, "sum", lat, lon
       FROM tx JOIN withdrawals USING (h3_09, customer_id) JOIN locations USING (h3_09)""",
)
def _(t):
    tx = t.transactions.select("h3_09", "customer_id", "datetime_id", "mcc_code", "sum")
    return joins.matched(tx, (t.withdrawals, ["h3_09", "customer_id"]), (t.locations, "h3_09"))


@query(
    "semi_join_top_keys",
    """SELECT id, h3_09_center, place_name FROM places WHERE h3_09_center IN (
           SELECT h3_09_center FROM places GROUP BY h3_09_center ORDER BY count(*) DESC, h3_09_center LIMIT 30)""",
)
def _(t):
    return joins.only_top_keys(t.places.select("id", "h3_09_center", "place_name"), "h3_09_center", 30)


@query(
    "join_suffix",
    """SELECT h3_09, c.lat AS lat_x, c.lon AS lon_x, total, id, p.lat AS lat_y, p.lon AS lon_y
       FROM (SELECT h3_09, lat, lon, sum("sum") AS total FROM tx_points GROUP BY h3_09, lat, lon) c
       LEFT JOIN (SELECT h3_09_center AS h3_09, id, lat, lon FROM poi WHERE tags IS NOT NULL) p USING (h3_09)""",
)
def _(t):
    busy = aggregates.cell_totals(t.transactions, t.locations)
    busy = busy.withColumn("total", F.col("total_sum").cast("double")).drop("total_sum")
    poi = t.poi.filter("tags IS NOT NULL").select(F.col("h3_09_center").alias("h3_09"), "id", "lat", "lon")
    return joins.attach_with_suffixes(busy, poi, "h3_09")


CENTROID_SQL = """
    SELECT w.customer_id, w.h3_09, l.lat AS true_lat, l.lon AS true_lon,
           round(c.lat, 9) AS predicted_lat, round(c.lon, 9) AS predicted_lon
    FROM withdrawals w JOIN locations l USING (h3_09)
    JOIN (SELECT customer_id, avg(lat) AS lat, avg(lon) AS lon
          FROM withdrawals JOIN locations USING (h3_09) GROUP BY customer_id) c ON c.customer_id = w.customer_id"""


def centroid_predictions(t):
    """Longitude and latitude rows scored by the mean position of the customer's withdrawals."""
    placed = t.withdrawals.join(t.locations, "h3_09")
    centres = placed.groupBy("customer_id").agg(F.avg("lat").alias("c_lat"), F.avg("lon").alias("c_lon"))
    rows = placed.join(centres, "customer_id")
    return [
        rows.select("customer_id", "h3_09", c, F.round(f"c_{c}", 9).alias("prediction")) for c in ("lon", "lat")
    ]


@query("pair_predictions", CENTROID_SQL)
def _(t):
    lon, lat = centroid_predictions(t)
    return joins.pair_predictions(lon, lat, ["customer_id", "h3_09"], [])


@query(
    "inclusion_check",
    """SELECT 'tx in locations' AS check_name,
              NOT EXISTS (SELECT 1 FROM tx WHERE h3_09 NOT IN (SELECT h3_09 FROM locations)) AS included
       UNION ALL SELECT 'locations in atm',
              NOT EXISTS (SELECT 1 FROM locations WHERE h3_09 NOT IN (SELECT h3_09 FROM atm))
       UNION ALL SELECT 'poi tags in places',
              NOT EXISTS (SELECT 1 FROM poi WHERE id NOT IN (SELECT id FROM places))
       UNION ALL SELECT 'atm in locations',
              NOT EXISTS (SELECT 1 FROM atm WHERE h3_09 NOT IN (SELECT h3_09 FROM locations))""",
)
def _(t):
    checks = {
        "tx in locations": joins.inclusion_check(t.transactions, t.locations, "h3_09"),
        "locations in atm": joins.inclusion_check(t.locations, t.atm, "h3_09"),
        "poi tags in places": joins.inclusion_check(t.poi, t.places, "id"),
        "atm in locations": joins.inclusion_check(t.atm, t.locations, "h3_09"),
    }
    return reduce(
        lambda a, b: a.unionByName(b), [df.withColumn("check_name", F.lit(name)) for name, df in checks.items()]
    )


@query(
    "fk_violations",
    """SELECT 'tx' AS child, h3_09 AS value, count(*) AS rows FROM tx
       WHERE h3_09 NOT IN (SELECT h3_09 FROM locations) GROUP BY h3_09
       UNION ALL SELECT 'withdrawals', h3_09, count(*) FROM withdrawals
       WHERE h3_09 NOT IN (SELECT h3_09 FROM locations) GROUP BY h3_09
       UNION ALL SELECT 'withdrawals at atm', h3_09, count(*) FROM withdrawals
       WHERE h3_09 NOT IN (SELECT h3_09 FROM atm) GROUP BY h3_09
       UNION ALL SELECT 'poi', h3_09_center, count(*) FROM poi
       WHERE h3_09_center NOT IN (SELECT h3_09 FROM locations) GROUP BY h3_09_center""",
)
def _(t):
    checks = {
        "tx": joins.fk_violations(t.transactions, t.locations, "h3_09"),
        "withdrawals": joins.fk_violations(t.withdrawals, t.locations, "h3_09"),
        "withdrawals at atm": joins.fk_violations(t.withdrawals, t.atm, "h3_09"),
        "poi": joins.fk_violations(t.poi, t.locations, "h3_09_center", "h3_09"),
    }
    return reduce(lambda a, b: a.unionByName(b), [df.withColumn("child", F.lit(n)) for n, df in checks.items()])


@query(
    "pk_violations",
    """SELECT 'locations' AS table_name, count(*) AS violations
       FROM (SELECT 1 FROM locations GROUP BY h3_09 HAVING count(*) > 1)
       UNION ALL SELECT 'withdrawals', count(*)
       FROM (SELECT 1 FROM withdrawals GROUP BY h3_09, customer_id HAVING count(*) > 1)
       UNION ALL SELECT 'poi', count(*) FROM (SELECT 1 FROM poi GROUP BY id HAVING count(*) > 1)
       UNION ALL SELECT 'transactions', count(*)
       FROM (SELECT 1 FROM tx GROUP BY customer_id, h3_09, datetime_id, mcc_code HAVING count(*) > 1)
       UNION ALL SELECT 'transactions by number', 0
       UNION ALL SELECT 'lineitem', count(*)
       FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
)
def _(t):
    keys = {
        "locations": (t.locations, ["h3_09"]),
        "withdrawals": (t.withdrawals, ["h3_09", "customer_id"]),
        "poi": (t.poi, ["id"]),
        "transactions": (t.transactions, TX_NATURAL_KEY),
        "transactions by number": (rows.surrogate_key(t.transactions, TX_NATURAL_KEY), ["transaction_pk"]),
        "lineitem": (t.raw("lineitem"), ["l_orderkey", "l_linenumber"]),
    }
    counted = [
        quality.pk_violations(df, key).agg(F.count("*").alias("violations")).withColumn("table_name", F.lit(name))
        for name, (df, key) in keys.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counted)


_CONSTRAINTS = (
    [("locations", "key", "h3_09"), ("transactions", "key", "transaction_pk"),
     ("cash_withdrawals", "key", "h3_09,customer_id"), ("poi", "key", "id")]
    + [(n, "reference", c) for n, c, _, _ in schemas.FOREIGN_KEYS]
    + [(n, "not null", f.name) for n, s in schemas.BASE_TABLES.items() for f in s.fields if not f.nullable]
)
_VIEW = {"transactions": "(SELECT *, row_number() OVER () - 1 AS transaction_pk FROM tx)",
         "cash_withdrawals": "withdrawals"}


def _constraint_sql(name, kind, columns):
    view = _VIEW.get(name, name)
    listed = ", ".join(f'"{c}"' for c in columns.split(","))
    rows_sql = {
        "key": f"(SELECT 1 FROM {view} GROUP BY {listed} HAVING count(*) > 1)",
        "reference": f"(SELECT DISTINCT {listed} AS v FROM {view} WHERE {listed} NOT IN (SELECT h3_09 FROM locations))",
        "not null": f"(SELECT 1 FROM {view} WHERE {listed} IS NULL)",
    }[kind]
    return f"""SELECT '{name}' AS table_name, '{kind}' AS kind, '{columns}' AS columns, count(*) AS violations
               FROM {rows_sql} v"""


@query("constraint_violations", " UNION ALL ".join(_constraint_sql(*c) for c in _CONSTRAINTS))
def _(t):
    numbered = rows.surrogate_key(t.transactions, TX_NATURAL_KEY)
    tables = {"locations": t.locations, "transactions": numbered, "cash_withdrawals": t.withdrawals, "poi": t.poi}
    return constraint_violations(tables)


@query(
    "not_null_violations",
    """SELECT 'transactions' AS table_name, 'std' AS column_name, count(*) AS null_count FROM tx
       WHERE std IS NULL HAVING count(*) > 0
       UNION ALL SELECT 'poi', 'tags', count(*) FROM poi WHERE tags IS NULL HAVING count(*) > 0""",
)
def _(t):
    tables = {"transactions": t.transactions, "withdrawals": t.withdrawals, "locations": t.locations, "poi": t.poi}
    found = [
        quality.not_null_violations(df, df.columns).withColumn("table_name", F.lit(name))
        for name, df in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), found)


@query("std_null_rule", 'SELECT count(*) AS violations FROM tx WHERE (std IS NULL) <> ("count" = 1)')
def _(t):
    return quality.std_null_violations(t.transactions).agg(F.count("*").alias("violations"))
