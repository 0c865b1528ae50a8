"""Distances, projections and spatial joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from hexledger.functions import geo, tags
from hexledger.operators import spatial
from hexledger.session import materialize, tasks_for
from registry.core import query

# Tag texts that one task parses.
PARSED_ROWS = 20_000
DEGREES_200M = 200 / geo.METRES_PER_DEGREE


def _haversine_sql(lat1, lon1, lat2, lon2):
    return (
        f"(2 * {geo.EARTH_RADIUS_M} * asin(least(1.0e0, sqrt(sin(radians({lat2} - {lat1}) / 2) ** 2 + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * sin(radians({lon2} - {lon1}) / 2) ** 2))))"
    )


def _utm_sql(lat, lon):
    """Zone 37 by the Krueger series, with the published numeric coefficients for WGS 84."""
    ecc = "0.08181919084262149e0"
    t = f"sinh(atanh(sin(radians({lat}))) - {ecc} * atanh({ecc} * sin(radians({lat}))))"
    xi = f"atan2({t}, cos(radians({lon} - 39)))"
    eta = f"atanh(sin(radians({lon} - 39)) / sqrt(1 + ({t}) ** 2))"
    coefficients = [
        "8.377318206244698e-4", "7.608527773572489e-7", "1.197645503242492e-9", "2.429170680397314e-12",
        "5.711818370428019e-15",
    ]
    radius = "6367449.145823415e0"
    east = " + ".join(
        [eta] + [f"{a} * cos({2 * j} * ({xi})) * sinh({2 * j} * ({eta}))" for j, a in enumerate(coefficients, 1)]
    )
    north = " + ".join(
        [xi] + [f"{a} * sin({2 * j} * ({xi})) * cosh({2 * j} * ({eta}))" for j, a in enumerate(coefficients, 1)]
    )
    return f"500000 + 0.9996e0 * {radius} * ({east})", f"0.9996e0 * {radius} * ({north})"


@query(
    "cell_to_latlng_join",
    "SELECT customer_id, h3_09, lat, lon FROM withdrawals LEFT JOIN locations USING (h3_09)",
)
def _(t):
    return t.withdrawals.join(t.locations, "h3_09", "left").select("customer_id", "h3_09", "lat", "lon")


@query(
    "assign_grid_cell",
    """SELECT id, CAST(CAST(floor(lat / 0.002e0) AS bigint) AS varchar) || ':' ||
              CAST(CAST(floor(lon / 0.002e0) AS bigint) AS varchar) AS grid_key FROM poi""",
)
def _(t):
    return t.poi.select("id", spatial.square_grid_key(F.col("lat"), F.col("lon"), 0.002).alias("grid_key"))


@query(
    "haversine_m",
    f"""SELECT id, round({_haversine_sql('p.lat', 'p.lon', 'l.lat', 'l.lon')}, 3) AS metres
        FROM poi p JOIN locations l ON p.h3_09_center = l.h3_09""",
)
def _(t):
    centres = t.locations.select(F.col("h3_09").alias("h3_09_center"), F.col("lat").alias("c_lat"), F.col("lon").alias("c_lon"))
    metres = geo.haversine_m(F.col("lat"), F.col("lon"), F.col("c_lat"), F.col("c_lon"))
    return t.poi.join(centres, "h3_09_center").select("id", F.round(metres, 3).alias("metres"))


@query(
    "project_mercator",
    """SELECT id, round(radians(lon) * 6378137, 3) AS x,
              round(6378137 * asinh(tan(radians(lat))), 3) AS y FROM poi""",
)
def _(t):
    return t.poi.select(
        "id", F.round(geo.mercator_x(F.col("lon")), 3).alias("x"), F.round(geo.mercator_y(F.col("lat")), 3).alias("y")
    )


_UTM_X, _UTM_Y = _utm_sql("lat", "lon")


@query("project_utm", f"SELECT id, round({_UTM_X}, 3) AS x, round({_UTM_Y}, 3) AS y FROM poi")
def _(t):
    x, y = geo.utm(F.col("lat"), F.col("lon"))
    return t.poi.select("id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query(
    "nearest_cell",
    f"""SELECT id, h3_09_nearest, round(d, 3) AS nearest_distance FROM (
            SELECT id, l.h3_09 AS h3_09_nearest, {_haversine_sql('p.lat', 'p.lon', 'l.lat', 'l.lon')} AS d,
                   row_number() OVER (PARTITION BY id ORDER BY
                       {_haversine_sql('p.lat', 'p.lon', 'l.lat', 'l.lon')}, l.h3_09) AS r
            FROM poi p CROSS JOIN locations l) WHERE r = 1""",
)
def _(t):
    found = spatial.nearest_site(t.poi.select("id", "lat", "lon"), t.locations, "h3_09", name="h3_09_nearest")
    return found.select("id", "h3_09_nearest", F.round("nearest_distance", 3).alias("nearest_distance"))


@query(
    "nearest_poi_type",
    f"""SELECT h3_09, poi_id, poi_type FROM (
            SELECT a.h3_09, p.id AS poi_id, lower(p_type) AS poi_type,
                   row_number() OVER (PARTITION BY a.h3_09 ORDER BY
                       {_haversine_sql('a.lat', 'a.lon', 'p.lat', 'p.lon')}, p.id) AS r
            FROM atm a CROSS JOIN poi p JOIN part ON p_partkey = p.id
            WHERE p_size % 7 <> 0 AND p_size % 2 <> 0) WHERE r = 1""",
)
def _(t):
    # Parsed once, by as many tasks as there is text to parse: the search and the last join both read it.
    dealt = t.poi.repartition(tasks_for(t.poi, PARSED_ROWS), "id")
    parsed = dealt.select("id", "lat", "lon", tags.tag_value(F.col("tags"), "type").alias("poi_type"))
    typed = materialize(parsed, "typed").filter("poi_type IS NOT NULL")
    found = spatial.nearest_site(t.atm, typed, "id", name="poi_id")
    kinds = typed.select(F.col("id").alias("poi_id"), "poi_type")
    return found.join(kinds, "poi_id", "left").select("h3_09", "poi_id", "poi_type")


def _projected(df):
    x, y = geo.utm(F.col("lat"), F.col("lon"))
    return df.withColumn("x", x).withColumn("y", y)


_CELL_DISTANCE_SQL = f"""
    SELECT c.h3_09, min(sqrt((c.x - a.x) ** 2 + (c.y - a.y) ** 2)) AS d
    FROM (SELECT h3_09, {_UTM_X} AS x, {_UTM_Y} AS y FROM locations) c
    CROSS JOIN (SELECT {_UTM_X} AS x, {_UTM_Y} AS y FROM atm) a GROUP BY c.h3_09"""


@query(
    "nearest_distance",
    f"""SELECT tx.h3_09, customer_id, datetime_id, mcc_code, round(d, 3) AS nearest_distance
        FROM tx JOIN ({_CELL_DISTANCE_SQL}) n ON n.h3_09 = tx.h3_09""",
)
def _(t):
    points = _projected(t.tx_points.select("h3_09", "customer_id", "datetime_id", "mcc_code", "lat", "lon"))
    near = spatial.nearest_distance(points, _projected(t.atm), "x", "y")
    return near.select(
        "h3_09", "customer_id", "datetime_id", "mcc_code", F.round("nearest_distance", 3).alias("nearest_distance")
    )


@query(
    "customer_atm_distance",
    f"""SELECT customer_id, round(avg(d), 3) AS avg_distance_to_nearest_atm
        FROM tx JOIN ({_CELL_DISTANCE_SQL}) n ON n.h3_09 = tx.h3_09 GROUP BY customer_id""",
)
def _(t):
    points = _projected(t.tx_points.select("customer_id", "lat", "lon"))
    means = spatial.customer_site_distance(points, _projected(t.atm), "x", "y")
    name = "avg_distance_to_nearest_atm"
    return means.select("customer_id", F.round(name, 3).alias(name))


@query(
    "poi_within_radius_m",
    f"""SELECT h3_09, count(id) AS poi_count FROM atm a
        LEFT JOIN (SELECT id, lat AS p_lat, lon AS p_lon FROM poi WHERE tags IS NOT NULL)
        ON {_haversine_sql('a.lat', 'a.lon', 'p_lat', 'p_lon')} <= 200 GROUP BY h3_09""",
)
def _(t):
    return spatial.within_radius_count(t.atm, t.poi.filter("tags IS NOT NULL"), 200.0).select("h3_09", "poi_count")


@query(
    "poi_within_radius_deg",
    f"""SELECT h3_09, count(id) AS poi_count FROM atm a
        LEFT JOIN (SELECT id, lat AS p_lat, lon AS p_lon FROM poi WHERE tags IS NOT NULL)
        ON sqrt((a.lat - p_lat) ** 2 + (a.lon - p_lon) ** 2) <= {DEGREES_200M!r}::double GROUP BY h3_09""",
)
def _(t):
    poi = t.poi.filter("tags IS NOT NULL")
    return spatial.within_radius_count(t.atm, poi, DEGREES_200M, metric=spatial.PLANAR).select("h3_09", "poi_count")


@query(
    "spatial_join_equal",
    """SELECT a.h3_09 AS h3_09_left, x.h3_09 AS h3_09_right, customer_id, datetime_id, mcc_code
       FROM atm a JOIN tx_points x ON a.lat = x.lat AND a.lon = x.lon""",
)
def _(t):
    points = t.tx_points.select("h3_09", "customer_id", "datetime_id", "mcc_code", "lat", "lon")
    return spatial.same_position_join(t.atm, points).drop("lat", "lon")


@query(
    "spatial_join_500m",
    f"""SELECT a.h3_09 AS h3_09_left, x.h3_09 AS h3_09_right, n_transactions
        FROM atm a JOIN (SELECT h3_09, lat, lon, count(*) AS n_transactions FROM tx_points GROUP BY h3_09, lat, lon) x
        ON {_haversine_sql('a.lat', 'a.lon', 'x.lat', 'x.lon')} <= 500""",
)
def _(t):
    busy = t.tx_points.groupBy("h3_09", "lat", "lon").agg(F.count("*").alias("n_transactions"))
    return spatial.spatial_join(t.atm, busy, 500.0).select("h3_09_left", "h3_09_right", "n_transactions")


@query(
    "customers_per_atm",
    f"""SELECT 'same position' AS form, a.h3_09, count(*) AS n_transactions, count(DISTINCT customer_id) AS n_customers
        FROM atm a JOIN tx_points x ON a.lat = x.lat AND a.lon = x.lon GROUP BY a.h3_09
        UNION ALL SELECT 'within 500 m', a.h3_09, count(*), count(DISTINCT customer_id)
        FROM atm a JOIN (SELECT h3_09 AS site, lat AS s_lat, lon AS s_lon FROM locations)
             ON {_haversine_sql('a.lat', 'a.lon', 's_lat', 's_lon')} <= 500
        JOIN tx ON tx.h3_09 = site GROUP BY a.h3_09""",
)
def _(t):
    tx = t.tx_points.select("lat", "lon", "customer_id")
    same = spatial.customers_near_sites(t.atm, tx, "h3_09").withColumn("form", F.lit("same position"))
    near = spatial.customers_near_sites(t.atm, tx, "h3_09", 500.0).withColumn("form", F.lit("within 500 m"))
    return same.unionByName(near)


@query(
    "mobility_radius",
    """WITH v AS (SELECT customer_id, lat, lon, count(*) AS n FROM tx_points GROUP BY customer_id, lat, lon),
       c AS (SELECT customer_id, avg(lat) AS cy, avg(lon) AS cx, sum(n) AS n_rows FROM v GROUP BY customer_id)
       SELECT customer_id, round(max(CASE WHEN n_rows < 2 THEN 0 ELSE sqrt((lon - cx) ** 2 + (lat - cy) ** 2) END), 6)
              AS mobility_radius FROM v JOIN c USING (customer_id) GROUP BY customer_id""",
)
def _(t):
    radius = spatial.mobility_radius(t.tx_points.select("customer_id", "lat", "lon"))
    return radius.withColumn("mobility_radius", F.round("mobility_radius", 6))
