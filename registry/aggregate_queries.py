"""Reports, summaries and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from hexledger.functions import values
from hexledger.operators import aggregates, metrics, quality, sets
from hexledger.plans.reports import TOP_CELLS, TOP_LABELS
from registry.core import query
from registry.join_queries import CENTROID_SQL, CUSTOMER_CELL_SQL, CUSTOMER_SQL, centroid_predictions, rounded_std


@query(
    "cell_totals",
    """SELECT h3_09, CAST(total AS decimal(15,2)) AS total_sum, lat, lon
       FROM (SELECT h3_09, round(sum("sum"), 2) AS total FROM tx GROUP BY h3_09) JOIN locations USING (h3_09)""",
)
def cell_totals(t):
    return aggregates.cell_totals(t.transactions, t.locations)


@query(
    "top_cells",
    f"""SELECT h3_09, CAST(total AS decimal(15,2)) AS total_sum, lat, lon
        FROM (SELECT h3_09, round(sum("sum"), 2) AS total FROM tx GROUP BY h3_09) JOIN locations USING (h3_09)
        ORDER BY total_sum DESC, h3_09 LIMIT {TOP_CELLS}""",
)
def _(t):
    return sets.top_k(aggregates.cell_totals(t.transactions, t.locations), "total_sum", ["h3_09"], TOP_CELLS)


_WORDS_SQL = """SELECT place_name AS text_label, CAST(sum(n) AS bigint) AS size_metric
    FROM places JOIN (SELECT h3_09, count(*) AS n FROM tx GROUP BY h3_09) ON h3_09 = h3_09_center GROUP BY place_name"""


@query("word_frequency", _WORDS_SQL)
def _(t):
    return aggregates.word_frequency(t.places, t.transactions)


@query("top_words", f"{_WORDS_SQL} ORDER BY size_metric DESC, text_label LIMIT {TOP_LABELS}")
def _(t):
    return sets.top_k(aggregates.word_frequency(t.places, t.transactions), "size_metric", ["text_label"], TOP_LABELS)


@query(
    "withdraw_rate",
    """SELECT CAST(sum(CASE WHEN w.customer_id IS NOT NULL THEN 1 ELSE 0 END) AS bigint) AS withdraw_tx,
              count(*) AS total_tx
       FROM tx LEFT JOIN withdrawals w ON tx.customer_id = w.customer_id AND tx.h3_09 = w.h3_09""",
)
def _(t):
    return aggregates.withdraw_rate(t.transactions, t.withdrawals)


@query("overall_totals", 'SELECT count(*) AS total_transactions, sum("sum") AS overall_sum FROM tx')
def _(t):
    return aggregates.overall_totals(t.transactions)


@query(
    "customer_stats",
    f"""SELECT * FROM ({CUSTOMER_SQL}) JOIN (SELECT customer_id, count(DISTINCT mcc_code) AS distinct_mcc_count
        FROM tx GROUP BY customer_id) USING (customer_id)""",
)
def _(t):
    return rounded_std(aggregates.customer_stats(t.transactions))


@query("customer_cell_stats", CUSTOMER_CELL_SQL)
def _(t):
    return aggregates.customer_cell_stats(t.transactions)


@query(
    "tags_per_cell",
    "SELECT h3_09_center AS h3_09, place_name, count(*) AS name_count FROM places GROUP BY h3_09_center, place_name",
)
def _(t):
    return aggregates.tags_per_cell(t.places)


@query(
    "top_center_names",
    """SELECT h3_09_center, place_name, count(*) AS name_count, center_count
       FROM places JOIN (SELECT h3_09_center, count(*) AS center_count FROM places
                         GROUP BY h3_09_center ORDER BY count(*) DESC, h3_09_center LIMIT 30) USING (h3_09_center)
       GROUP BY h3_09_center, place_name, center_count""",
)
def _(t):
    return aggregates.top_center_names(t.places)


@query(
    "customer_summary",
    """SELECT customer_id, CAST(sum("count") AS bigint) AS "count", sum("sum") AS "sum",
              count(DISTINCT h3_09) AS n_cells, count(DISTINCT mcc_code) AS n_mcc FROM tx GROUP BY customer_id""",
)
def _(t):
    return aggregates.customer_summary(t.transactions)


@query(
    "location_summary",
    """SELECT h3_09, CAST(sum("count") AS bigint) AS "count", sum("sum") AS "sum",
              count(DISTINCT customer_id) AS n_customers FROM tx GROUP BY h3_09""",
)
def _(t):
    return aggregates.location_summary(t.transactions)


@query(
    "value_counts",
    """SELECT 'with nulls' AS form, tags AS value, count(*) AS n FROM poi GROUP BY tags
       UNION ALL SELECT 'without nulls', tags, count(*) FROM poi WHERE tags IS NOT NULL GROUP BY tags""",
)
def _(t):
    def form(name, df):
        return df.select(F.lit(name).alias("form"), F.col("tags").alias("value"), "n")

    return form("with nulls", aggregates.value_counts(t.poi, "tags")).unionByName(
        form("without nulls", aggregates.value_counts(t.poi, "tags", with_nulls=False))
    )


TX_COLUMNS = [
    "h3_09", "customer_id", "datetime_id", "count", "sum", "avg", "min", "max", "std", "count_distinct", "mcc_code",
]
NUMERIC = ["count", "sum", "avg", "min", "max", "std"]


def _per_column(columns, expression, value):
    return "\nUNION ALL ".join(
        f"""SELECT '{c}' AS column_name, {expression.format(c='"' + c + '"')} AS {value} FROM tx""" for c in columns
    )


@query("null_counts", _per_column(TX_COLUMNS, "count(*) FILTER (WHERE {c} IS NULL)", "null_count"))
def _(t):
    return quality.null_counts(t.transactions)


@query(
    "zero_counts",
    _per_column([*NUMERIC, "datetime_id", "mcc_code"], "count(*) FILTER (WHERE {c} = 0)", "zero_count"),
)
def _(t):
    return quality.zero_counts(t.transactions, [*NUMERIC, "datetime_id", "mcc_code"])


@query("distinct_counts", _per_column(TX_COLUMNS, "count(DISTINCT {c})", "distinct_count"))
def _(t):
    return quality.distinct_counts(t.transactions, TX_COLUMNS)


@query(
    "table_row_counts",
    """WITH c AS (SELECT 'transactions' AS table_name, count(*) AS n_rows FROM tx
                  UNION ALL SELECT 'cash_withdrawals', count(*) FROM withdrawals
                  UNION ALL SELECT 'locations', count(*) FROM locations
                  UNION ALL SELECT 'poi', count(*) FROM poi)
       SELECT * FROM c UNION ALL SELECT 'total', CAST(sum(n_rows) AS bigint) FROM c""",
)
def _(t):
    return aggregates.table_row_counts(
        {
            "transactions": t.transactions,
            "cash_withdrawals": t.withdrawals,
            "locations": t.locations,
            "poi": t.poi,
        }
    )


@query(
    "atm_density",
    """SELECT h3_09, customer_id, datetime_id, mcc_code, h3_08, coalesce(atm_count, 0) AS atm_count
       FROM (SELECT *, format('{:x}', ((CAST('0x' || h3_09 AS bigint) & ~(15::bigint << 52)) | (8::bigint << 52))
                               | 2097151::bigint) AS h3_08 FROM tx)
       LEFT JOIN (SELECT format('{:x}', ((CAST('0x' || h3_09 AS bigint) & ~(15::bigint << 52)) | (8::bigint << 52))
                               | 2097151::bigint) AS h3_08, count(*) AS atm_count FROM atm GROUP BY 1) USING (h3_08)""",
)
def _(t):
    tx = t.transactions.select("h3_09", "customer_id", "datetime_id", "mcc_code")
    return aggregates.atm_density(tx, t.atm)


@query(
    "parent_cell_avg",
    """SELECT h3_09, customer_id, datetime_id, mcc_code, h3_08, avg("sum") OVER (PARTITION BY h3_08) AS avg_sum
       FROM (SELECT *, format('{:x}', ((CAST('0x' || h3_09 AS bigint) & ~(15::bigint << 52)) | (8::bigint << 52))
                               | 2097151::bigint) AS h3_08 FROM tx)""",
)
def _(t):
    tx = t.transactions.select("h3_09", "customer_id", "datetime_id", "mcc_code", "sum")
    return aggregates.parent_cell_avg(tx).drop("sum")


@query(
    "parent_cell_totals",
    """SELECT format('{:x}', ((CAST('0x' || h3_09 AS bigint) & ~(15::bigint << 52)) | (7::bigint << 52))
                      | 16777215::bigint) AS parent_cell, count(*) AS n_transactions, sum("sum") AS total_sum
       FROM tx GROUP BY 1""",
)
def _(t):
    return aggregates.parent_cell_totals(t.transactions, 7)


@query(
    "empty_token_count",
    """SELECT count(*) AS empty_tokens FROM tx JOIN withdrawals USING (h3_09, customer_id)
       LEFT JOIN cell_tags USING (h3_09) WHERE tags_key IS NULL""",
)
def _(t):
    pairs = t.transactions.select("h3_09", "customer_id").join(t.withdrawals, ["h3_09", "customer_id"])
    names = t.places.select(F.col("h3_09_center").alias("h3_09"), F.size(values.tokens(F.col("place_name"))).alias("n"))
    tokens = names.groupBy("h3_09").agg(F.sum("n").alias("n_tokens"))
    return aggregates.empty_token_count(pairs.join(tokens, "h3_09", "left"))


FAVOURITE_SQL = """
    SELECT w.h3_09 AS label, f.h3_09 AS prediction FROM withdrawals w JOIN (
        SELECT customer_id, h3_09 FROM (
            SELECT customer_id, h3_09, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, h3_09) AS r
            FROM tx GROUP BY customer_id, h3_09) WHERE r = 1) f ON f.customer_id = w.customer_id"""


def favourite_predictions(t):
    """The cell of each withdrawal against the customer's busiest cell."""
    visits = aggregates.customer_cell_stats(t.transactions).select(
        "customer_id", F.col("h3_09").alias("prediction"), "location_transaction_count"
    )
    favourite = sets.best_per_group(
        visits, ["customer_id"], [F.desc("location_transaction_count"), F.asc("prediction")]
    )
    return t.withdrawals.join(favourite, "customer_id").select(F.col("h3_09").alias("label"), "prediction")


_REPORT_SQL = f"""
    WITH p AS ({FAVOURITE_SQL}),
    c AS (SELECT label AS class, count(*) AS support, count(*) FILTER (WHERE label = prediction) AS tp
          FROM p GROUP BY label),
    q AS (SELECT prediction AS class, count(*) AS predicted FROM p GROUP BY prediction),
    s AS (SELECT support, tp, CASE WHEN coalesce(predicted, 0) > 0 THEN tp / predicted ELSE 0.0 END AS pr,
                 tp / support AS rc FROM c LEFT JOIN q USING (class)),
    f AS (SELECT *, CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END AS f1 FROM s)"""


@query(
    "classification_report",
    f"""{_REPORT_SQL} SELECT round(sum(tp) / sum(support), 9) AS accuracy, round(avg(f1), 9) AS macro_f1 FROM f""",
)
def _(t):
    report = metrics.classification_report(favourite_predictions(t))
    return report.select(F.round("accuracy", 9).alias("accuracy"), F.round("macro_f1", 9).alias("macro_f1"))


@query(
    "multiclass_metrics",
    f"""{_REPORT_SQL} SELECT round(sum(tp) / sum(support), 9) AS accuracy,
        round(sum(f1 * support) / sum(support), 9) AS weighted_f1 FROM f""",
)
def _(t):
    report = metrics.classification_report(favourite_predictions(t))
    return report.select(F.round("accuracy", 9).alias("accuracy"), F.round("weighted_f1", 9).alias("weighted_f1"))


@query(
    "regression_metrics",
    f"""SELECT 'lon' AS coord, round(avg(abs(predicted_lon - true_lon)), 9) AS mae,
               round(sqrt(avg((predicted_lon - true_lon) ** 2)), 9) AS rmse FROM ({CENTROID_SQL})
        UNION ALL SELECT 'lat', round(avg(abs(predicted_lat - true_lat)), 9),
               round(sqrt(avg((predicted_lat - true_lat) ** 2)), 9) FROM ({CENTROID_SQL})""",
)
def _(t):
    lon, lat = centroid_predictions(t)

    def measured(df, coord):
        m = metrics.regression_metrics(df, coord, "prediction")
        return m.select(F.lit(coord).alias("coord"), F.round("mae", 9).alias("mae"), F.round("rmse", 9).alias("rmse"))

    return measured(lon, "lon").unionByName(measured(lat, "lat"))


_TRIALS_SQL = """
    SELECT l_returnflag AS "table", l_linestatus AS format, CAST(quarter(l_shipdate) AS varchar) AS codec,
           CASE WHEN l_returnflag = 'N' AND quarter(l_shipdate) = 4 THEN 'FAILED' ELSE 'OK' END AS status,
           sum(round(l_quantity)) AS size_mb, sum(round(l_extendedprice)) AS original_size_mb,
           round(sum(round(l_extendedprice)) / sum(round(l_quantity)), 2) AS compression_ratio,
           CAST(count(*) AS double) AS import_time_sec, CAST(count(DISTINCT l_suppkey) AS double) AS read_time_sec
    FROM lineitem GROUP BY l_returnflag, l_linestatus, quarter(l_shipdate)"""
_TRIAL_TEXT = """concat_ws(',', "table", format, codec, CAST(size_mb AS varchar), CAST(original_size_mb AS varchar),
    CAST(compression_ratio AS varchar), CAST(import_time_sec AS varchar), CAST(read_time_sec AS varchar))"""


@query(
    "best_format_per_table",
    f"""WITH r AS (SELECT *, {_TRIAL_TEXT} AS txt FROM ({_TRIALS_SQL}) WHERE status <> 'FAILED'),
        s AS (SELECT "table" AS scope, * FROM r UNION ALL SELECT 'overall', * FROM r)
        SELECT scope, 'compression' AS kind, "table", format, codec FROM (
            SELECT *, row_number() OVER (PARTITION BY scope ORDER BY compression_ratio DESC, txt DESC) AS k FROM s)
        WHERE k = 1
        UNION ALL SELECT scope, 'read', "table", format, codec FROM (
            SELECT *, row_number() OVER (PARTITION BY scope ORDER BY read_time_sec, txt) AS k FROM s) WHERE k = 1""",
)
def _(t):
    quantity, price = F.sum(F.round("l_quantity")), F.sum(F.round("l_extendedprice"))
    failed = (F.col("table") == "N") & (F.col("codec") == "4")
    trials = (
        t.raw("lineitem")
        .groupBy(
            F.col("l_returnflag").alias("table"),
            F.col("l_linestatus").alias("format"),
            F.quarter("l_shipdate").cast("string").alias("codec"),
        )
        .agg(
            quantity.alias("size_mb"),
            price.alias("original_size_mb"),
            F.round(price / quantity, 2).alias("compression_ratio"),
            F.count("*").cast("double").alias("import_time_sec"),
            F.count_distinct("l_suppkey").cast("double").alias("read_time_sec"),
        )
        .withColumn("status", F.when(failed, "FAILED").otherwise("OK"))
    )
    return aggregates.best_formats(trials)
