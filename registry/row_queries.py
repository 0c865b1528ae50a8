"""Filters, projections, null handling, scalar functions, ordering, sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from hexledger.functions import cells, geo, tags, values
from hexledger.operators import aggregates, features, rows, sets
from hexledger.plans.reports import named_places
from registry.bindings import cell_id
from registry.core import query

TX_KEY = ["customer_id", "h3_09", "datetime_id", "mcc_code"]
TX_KEY_SQL = "customer_id, h3_09, datetime_id, mcc_code"
_MASK = "(15::bigint << 52)"


@query("filter_amount_cap", f'SELECT {TX_KEY_SQL}, "sum" FROM tx WHERE "sum" <= 200000')
def _(t):
    return rows.amount_cap(t.transactions).select(*TX_KEY, "sum")


@query("filter_not_null", "SELECT id, tags FROM poi WHERE tags IS NOT NULL")
def _(t):
    return rows.not_null(t.poi, "tags").select("id", "tags")


@query("filter_tag_excluded", "SELECT id, tags FROM poi WHERE NOT contains(tags, 'operator')")
def _(t):
    return rows.without_tag(t.poi, "operator").select("id", "tags")


@query(
    "project_rename",
    f'SELECT {TX_KEY_SQL}, "sum" AS amount, "count" AS operations FROM tx',
)
def _(t):
    renamed = t.transactions.drop("avg", "min", "max", "std", "count_distinct")
    return renamed.withColumnsRenamed({"sum": "amount", "count": "operations"})


@query(
    "select_numeric",
    'SELECT customer_id, datetime_id, "count", "sum", "avg", "min", "max", std, count_distinct, mcc_code FROM tx',
)
def _(t):
    return rows.select_numeric(t.transactions)


@query(
    "cast_types",
    f"""SELECT {TX_KEY_SQL}, CAST("sum" AS decimal(15,2)) AS sum_decimal, CAST("sum" AS bigint) AS sum_long,
               CAST("count" AS integer) AS count_int, CAST(customer_id AS varchar) AS customer_text FROM tx""",
)
def _(t):
    return t.transactions.select(
        *TX_KEY,
        F.col("sum").cast("decimal(15,2)").alias("sum_decimal"),
        F.col("sum").cast("long").alias("sum_long"),
        F.col("count").cast("int").alias("count_int"),
        F.col("customer_id").cast("string").alias("customer_text"),
    )


@query(
    "default_label",
    """SELECT h3_09, coalesce(tags_key, 'Unknown') AS tags_key FROM locations LEFT JOIN cell_tags USING (h3_09)""",
)
def _(t):
    return features.with_tag_key(t.locations.select("h3_09"), t.places, "Unknown")


@query(
    "fill_nulls",
    f"SELECT {TX_KEY_SQL}, coalesce(std, 0) AS std FROM tx",
)
def _(t):
    return rows.fill_null_numbers(t.transactions).select(*TX_KEY, "std")


@query("drop_nulls", f"SELECT {TX_KEY_SQL}, std FROM tx WHERE std IS NOT NULL")
def _(t):
    return rows.drop_null_rows(t.transactions, ["std", "sum"]).select(*TX_KEY, "std")


@query("head_n", f'SELECT {TX_KEY_SQL}, "sum" FROM tx ORDER BY {TX_KEY_SQL} LIMIT 1000')
def _(t):
    return rows.head(t.transactions.select(*TX_KEY, "sum"), TX_KEY, 1000)


@query(
    "surrogate_key",
    f"SELECT {TX_KEY_SQL}, row_number() OVER (ORDER BY {TX_KEY_SQL}) - 1 AS transaction_pk FROM tx",
)
def _(t):
    return rows.surrogate_key(t.transactions.select(*TX_KEY), TX_KEY)


@query(
    "train_test_split",
    """SELECT customer_id, h3_09, CASE WHEN
              CAST('0x' || substr(md5(concat_ws('|', CAST(customer_id AS varchar), h3_09)), 1, 8) AS bigint) % 100 < 80
              THEN 'train' ELSE 'test' END AS part FROM withdrawals""",
)
def _(t):
    train, test = rows.key_split(t.withdrawals, ["customer_id", "h3_09"])
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("sort_by_key", f'SELECT {TX_KEY_SQL}, "sum" FROM tx ORDER BY {TX_KEY_SQL}')
def _(t):
    return t.transactions.select(*TX_KEY, "sum").orderBy(*TX_KEY)


@query("top_k", f'SELECT {TX_KEY_SQL}, "sum" FROM tx ORDER BY "sum" DESC, {TX_KEY_SQL} LIMIT 30')
def _(t):
    return sets.top_k(t.transactions.select(*TX_KEY, "sum"), "sum", TX_KEY, 30)


@query("union_distinct", "SELECT DISTINCT h3_09 FROM (SELECT h3_09 FROM tx UNION ALL SELECT h3_09 FROM withdrawals)")
def _(t):
    return sets.union_distinct(t.transactions.select("h3_09"), t.withdrawals.select("h3_09"))


@query(
    "has_duplicates",
    """SELECT 'lineitem' AS table_name, count(*) > 0 AS has_duplicates
       FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
       UNION ALL
       SELECT 'locations', count(*) > 0 FROM (SELECT 1 FROM locations GROUP BY h3_09, lat, lon HAVING count(*) > 1)""",
)
def _(t):
    lines = sets.has_duplicates(t.raw("lineitem"), ["l_orderkey", "l_linenumber"])
    places = sets.has_duplicates(t.locations)
    return (
        lines.withColumn("table_name", F.lit("lineitem"))
        .unionByName(places.withColumn("table_name", F.lit("locations")))
    )


@query("distinct_values", "SELECT DISTINCT customer_id FROM tx")
def _(t):
    return sets.distinct_values(t.transactions, "customer_id")


@query("normalize_text", "SELECT p_partkey, lower(trim(p_type || '  ')) AS label FROM part")
def _(t):
    return t.raw("part").select(
        "p_partkey", values.normalize_text(F.concat("p_type", F.lit("  "))).alias("label")
    )


@query(
    "explode_tags",
    """SELECT id, unnest(string_split_regex(substr(tags, 2, length(tags) - 2), '''\\),\\s*\\(''')) AS piece
       FROM poi WHERE tags IS NOT NULL""",
)
def _(t):
    return t.poi.select("id", F.explode(tags.tag_pieces(F.col("tags"))).alias("piece"))


@query("tag_name_literal", "SELECT id, h3_09_center, lat, lon, place_name FROM places")
def _(t):
    return named_places(t.poi).drop("h3_09")


_TAG_ROWS_SQL = """
    SELECT p_partkey AS id, 'name' AS key, p_name AS value FROM part WHERE p_size % 7 <> 0
    UNION ALL SELECT p_partkey, 'brand', p_brand FROM part WHERE p_size % 7 <> 0 AND p_size % 2 <> 0
    UNION ALL SELECT p_partkey, 'operator', 'O''Neil' FROM part WHERE p_size % 7 <> 0 AND p_size % 2 <> 0
    UNION ALL SELECT p_partkey, 'type', p_type FROM part WHERE p_size % 7 <> 0 AND p_size % 2 <> 0"""


@query("tag_map", _TAG_ROWS_SQL)
def _(t):
    return t.poi.select("id", F.explode(tags.tag_map(F.col("tags"))).alias("key", "value"))


@query(
    "tag_value",
    """SELECT p_partkey AS id, CASE WHEN p_size % 7 <> 0 THEN lower(trim(p_name)) END AS name,
              CASE WHEN p_size % 7 <> 0 AND p_size % 2 <> 0 THEN 'o''neil' END AS operator FROM part""",
)
def _(t):
    return t.poi.select(
        "id",
        tags.tag_value(F.col("tags"), "name").alias("name"),
        tags.tag_value(F.col("tags"), "operator").alias("operator"),
    )


@query(
    "split_tokens",
    """SELECT id, place_name, len(string_split(place_name, ' ')) AS n_tokens,
              array_to_string(string_split(place_name, ' '), '|') AS joined FROM places""",
)
def _(t):
    token = values.tokens(F.col("place_name"))
    return t.places.select(
        "id",
        "place_name",
        F.size(token).cast("long").alias("n_tokens"),
        F.concat_ws("|", token).alias("joined"),
    )


@query(
    "math_scalars",
    f"""SELECT {TX_KEY_SQL}, round("avg", 2) AS avg_2, round(ln(1 + "sum"), 9) AS log1p_sum,
               round(radians("count"), 9) AS radians_count, sqrt("min" * "min" + "max" * "max") AS planar FROM tx""",
)
def _(t):
    zero = F.lit(0.0)
    return t.transactions.select(
        *TX_KEY,
        F.round("avg", 2).alias("avg_2"),
        F.round(F.log1p("sum"), 9).alias("log1p_sum"),
        F.round(F.radians("count"), 9).alias("radians_count"),
        geo.planar(zero, zero, F.col("min"), F.col("max")).alias("planar"),
    )


def _parent_sql(n: str, resolution: int) -> str:
    unused = (1 << (3 * (15 - resolution))) - 1
    return f"format('{{:x}}', (({n} & ~{_MASK}) | ({resolution}::bigint << 52)) | {unused}::bigint)"


@query(
    "cell_parent",
    f"""SELECT h3_09, {_parent_sql('n', 8)} AS h3_08, {_parent_sql('n', 7)} AS h3_07
        FROM (SELECT h3_09, CAST('0x' || h3_09 AS bigint) AS n FROM locations)""",
)
def _(t):
    cell = F.col("h3_09")
    return t.locations.select(
        "h3_09", cells.cell_to_parent(cell, 8).alias("h3_08"), cells.cell_to_parent(cell, 7).alias("h3_07")
    )


@query(
    "cell_resolution",
    "SELECT h3_09, 9 AS resolution, 7 AS parent_resolution FROM locations",
)
def _(t):
    cell = F.col("h3_09")
    return t.locations.select(
        "h3_09",
        cells.cell_resolution(cell).alias("resolution"),
        cells.cell_resolution(cells.cell_to_parent(cell, 7)).alias("parent_resolution"),
    )


def _damaged_ids(t):
    """Ids from parts: valid, wrong mode, a used digit 7, an unused digit not 7, not hexadecimal."""
    n = cells.cell_to_long(cell_id("p_partkey"))

    def bit(value: int):
        return F.lit(value).cast("long")

    damaged = (
        F.when(F.col("p_size") % 5 == 0, cells.long_to_cell(n))
        .when(F.col("p_size") % 5 == 1, cells.long_to_cell(n.bitwiseOR(bit(2 << 59))))
        .when(F.col("p_size") % 5 == 2, cells.long_to_cell(n.bitwiseOR(bit(7 << 21))))
        .when(F.col("p_size") % 5 == 3, cells.long_to_cell(n.bitwiseAND(bit(~1))))
        .otherwise(F.concat(F.lit("x"), F.substring(cells.long_to_cell(n), 2, 14)))
    )
    return t.raw("part").select("p_partkey", damaged.alias("h3_09"))


@query("cell_is_valid", "SELECT p_partkey, p_size % 5 = 0 AS is_valid FROM part")
def _(t):
    return _damaged_ids(t).select("p_partkey", cells.cell_is_valid(F.col("h3_09")).alias("is_valid"))


@query(
    "cell_resolution_census",
    """SELECT p_size % 5 = 0 AS is_valid, CASE WHEN p_size % 5 = 0 THEN 9 END AS resolution, count(*) AS n
       FROM part GROUP BY 1, 2""",
)
def _(t):
    return aggregates.cell_census(_damaged_ids(t))
