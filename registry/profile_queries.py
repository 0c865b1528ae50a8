"""Column profiles, distributions and extents."""

from __future__ import annotations

from pyspark.sql import functions as F

from hexledger.operators import profile
from registry.aggregate_queries import NUMERIC
from registry.core import query

_ALL = ["customer_id", "datetime_id", "count", "sum", "avg", "min", "max", "std", "count_distinct", "mcc_code"]


def _long_sql(columns, carried=""):
    listed = ", ".join(f'CAST("{c}" AS double) AS "{c}"' for c in columns)
    names = ", ".join(f'"{c}"' for c in columns)
    keep = f"{carried}, " if carried else ""
    return f"UNPIVOT (SELECT {keep}{listed} FROM tx) ON {names} INTO NAME column_name VALUE v"


_DESCRIBE_SQL = f"""
    SELECT column_name, count(v) AS "count", round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std,
           min(v) AS "min", max(v) AS "max", round(quantile_cont(v, 0.25), 6) AS q25,
           round(quantile_cont(v, 0.5), 6) AS q50, round(quantile_cont(v, 0.75), 6) AS q75
    FROM ({_long_sql(_ALL)}) GROUP BY column_name"""


def _rounded(df):
    return df.withColumns(
        {
            "mean": F.round("mean", 4),
            "std": F.round("std", 4),
            **{c: F.round(c, 6) for c in ("q25", "q50", "q75") if c in df.columns},
        }
    )


@query("describe_numeric", _DESCRIBE_SQL)
def _(t):
    return _rounded(profile.describe_numeric(t.transactions))


@query(
    "format_profile",
    f"""SELECT column_name, format('{{:,}}', "count") AS "count", printf('%.4f', mean) AS mean,
               printf('%.4f', std) AS std, printf('%.4f', "min") AS "min", printf('%.4f', q25) AS q25,
               printf('%.4f', q50) AS q50, printf('%.4f', q75) AS q75, printf('%.4f', "max") AS "max"
        FROM ({_DESCRIBE_SQL})""",
)
def _(t):
    return profile.format_profile(_rounded(profile.describe_numeric(t.transactions)))


_PROFILED = {
    "h3_09": "string",
    "customer_id": "bigint",
    "datetime_id": "smallint",
    "count": "smallint",
    "sum": "double",
    "avg": "double",
    "min": "double",
    "max": "double",
    "std": "double",
    "count_distinct": "smallint",
    "mcc_code": "smallint",
}
_PROFILED_NUMERIC = [c for c, kind in _PROFILED.items() if kind != "string"]
_TEXT_UNPIVOT = (
    "SELECT column_name, v FROM (SELECT "
    + ", ".join(f'CAST("{c}" AS varchar) AS "{c}"' for c in _PROFILED)
    + " FROM tx) UNPIVOT INCLUDE NULLS (v FOR column_name IN ("
    + ", ".join(f'"{c}"' for c in _PROFILED)
    + "))"
)
_TYPE_CASE = " ".join(f"WHEN '{c}' THEN '{kind}'" for c, kind in _PROFILED.items())


@query(
    "column_profile",
    f"""WITH f AS (SELECT column_name, v, count(*) AS n FROM ({_TEXT_UNPIVOT}) GROUP BY column_name, v),
        ranked AS (SELECT *, coalesce(v, 'null') || ': ' || n AS entry,
                   row_number() OVER (PARTITION BY column_name ORDER BY n DESC, v NULLS FIRST) AS t,
                   row_number() OVER (PARTITION BY column_name ORDER BY n, v NULLS FIRST) AS b FROM f),
        lists AS (SELECT column_name, string_agg(entry, ', ' ORDER BY t) FILTER (WHERE t <= 3) AS top_values,
                         string_agg(entry, ', ' ORDER BY b) FILTER (WHERE b <= 3) AS bottom_values,
                         count(v) AS n_unique, CAST(sum(n) FILTER (WHERE v IS NOT NULL) AS bigint) AS "count",
                         arg_min(v, (-n, v)) FILTER (WHERE v IS NOT NULL) AS mode
                  FROM ranked GROUP BY column_name),
        nums AS (SELECT column_name, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std, min(v) AS "min",
                        quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS q50, quantile_cont(v, 0.75) AS q75,
                        max(v) AS "max" FROM ({_long_sql(_PROFILED_NUMERIC)}) GROUP BY column_name)
        SELECT column_name, CASE column_name {_TYPE_CASE} END AS dtype, n_unique, "count", mean, std, "min",
               round(q25, 6) AS q25, CASE WHEN column_name = 'h3_09' THEN mode ELSE CAST(q50 AS varchar) END AS median,
               round(q75, 6) AS q75, "max", top_values, bottom_values
        FROM lists LEFT JOIN nums USING (column_name)""",
)
def _(t):
    return _rounded(profile.column_profile(t.transactions.select(*_PROFILED)))


def _histogram_sql(value, rows=None):
    return f"""
        WITH x AS (SELECT column_name, {value} AS v FROM ({rows or _long_sql(NUMERIC)})),
        b AS (SELECT column_name, min(v) AS lo, max(v) AS hi FROM x GROUP BY column_name),
        p AS (SELECT x.column_name, lo, hi, CASE WHEN lo = hi THEN 0
                     ELSE least(floor((v - lo) / ((hi - lo) / 45)), 44) END AS bin FROM x JOIN b USING (column_name))
        SELECT column_name, CAST(bin AS integer) AS bin, round(lo + bin * ((hi - lo) / 45), 6) AS bin_low,
               count(*) AS n FROM p GROUP BY column_name, lo, hi, bin"""


@query("histogram", _histogram_sql("v"))
def _(t):
    return profile.histogram(t.transactions, NUMERIC).withColumn("bin_low", F.round("bin_low", 6))


_CUSTOMER_ROWS_SQL = """
    SELECT 'customer_id' AS column_name, CAST(customer_id AS double) AS v FROM tx
    UNION ALL SELECT 'transactions', CAST(count(*) AS double) FROM tx GROUP BY customer_id"""


@query("histogram_customers", _histogram_sql("v", _CUSTOMER_ROWS_SQL))
def _(t):
    return profile.customer_histograms(t.transactions).withColumn("bin_low", F.round("bin_low", 6))


@query("histogram_log1p", _histogram_sql("ln(1 + v)"))
def _(t):
    return profile.histogram(t.transactions, NUMERIC, log1p=True).withColumn("bin_low", F.round("bin_low", 6))


def _boxplot_sql(columns, by=""):
    keys = f"{by}, column_name" if by else "column_name"
    return f"""
        WITH x AS ({_long_sql(columns, by)}),
        q AS (SELECT {keys}, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
                     quantile_cont(v, 0.75) AS q3 FROM x GROUP BY {keys})
        SELECT {keys}, q1, median, q3,
               min(v) FILTER (WHERE v BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1)) AS whisker_low,
               max(v) FILTER (WHERE v BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1)) AS whisker_high,
               count(*) FILTER (WHERE v NOT BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1)) AS outliers
        FROM x JOIN q USING ({keys}) GROUP BY {keys}, q1, median, q3"""


@query("boxplot_stats", _boxplot_sql(NUMERIC))
def _(t):
    return profile.boxplot_stats(t.transactions, NUMERIC)


@query(
    "boxplot_by_group",
    f"""SELECT 'datetime_id' AS grouping, CAST(datetime_id AS integer) AS "group", * EXCLUDE (datetime_id)
        FROM ({_boxplot_sql(['sum'], 'datetime_id')})
        UNION ALL SELECT 'mcc_code', CAST(mcc_code AS integer), * EXCLUDE (mcc_code)
        FROM ({_boxplot_sql(['sum'], 'mcc_code')})""",
)
def _(t):
    def grouped(by):
        stats = profile.boxplot_stats(t.transactions, ["sum"], [by])
        return stats.withColumn("grouping", F.lit(by)).withColumn("group", F.col(by).cast("int")).drop(by)

    return grouped("datetime_id").unionByName(grouped("mcc_code"))


@query(
    "correlation_matrix",
    "\nUNION ALL ".join(
        f"""SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr("{a}", "{b}"), 6) AS corr FROM tx"""
        for a in _ALL
        for b in _ALL
    ),
)
def _(t):
    return profile.correlation_matrix(t.transactions).withColumn("corr", F.round("corr", 6))


@query(
    "bounding_box",
    """SELECT min(lon) AS min_lon, min(lat) AS min_lat, max(lon) AS max_lon, max(lat) AS max_lat,
              round(avg(lat), 9) AS center_lat, round(avg(lon), 9) AS center_lon FROM tx_points""",
)
def _(t):
    box = profile.bounding_box(t.tx_points)
    return box.withColumns({c: F.round(c, 9) for c in ("center_lat", "center_lon")})
