"""Explicit schemas of the base tables and of the stored results."""

from __future__ import annotations

from pyspark.sql import types as T

LOCATIONS = T.StructType(
    [
        T.StructField("h3_09", T.StringType(), False),
        T.StructField("lat", T.FloatType()),
        T.StructField("lon", T.FloatType()),
    ]
)

TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_pk", T.LongType(), False),
        T.StructField("h3_09", T.StringType(), False),
        T.StructField("customer_id", T.LongType(), False),
        T.StructField("datetime_id", T.ShortType(), False),
        T.StructField("count", T.ShortType(), False),
        T.StructField("sum", T.FloatType(), False),
        T.StructField("avg", T.FloatType(), False),
        T.StructField("min", T.FloatType(), False),
        T.StructField("max", T.FloatType(), False),
        T.StructField("std", T.FloatType()),
        T.StructField("count_distinct", T.ShortType(), False),
        T.StructField("mcc_code", T.ShortType(), False),
    ]
)

CASH_WITHDRAWALS = T.StructType(
    [
        T.StructField("h3_09", T.StringType(), False),
        T.StructField("customer_id", T.LongType(), False),
    ]
)

POI = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("tags", T.StringType()),
        T.StructField("lat", T.FloatType()),
        T.StructField("lon", T.FloatType()),
        T.StructField("h3_09", T.StringType()),
        T.StructField("h3_09_center", T.StringType()),
    ]
)

STORAGE_TRIAL = T.StructType(
    [
        T.StructField("table", T.StringType(), False),
        T.StructField("format", T.StringType(), False),
        T.StructField("codec", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("rows", T.LongType()),
        T.StructField("size_mb", T.DoubleType()),
        T.StructField("original_size_mb", T.DoubleType()),
        T.StructField("compression_ratio", T.DoubleType()),
        T.StructField("import_time_sec", T.DoubleType()),
        T.StructField("read_time_sec", T.DoubleType()),
    ]
)

BASE_TABLES = {
    "locations": LOCATIONS,
    "transactions": TRANSACTIONS,
    "cash_withdrawals": CASH_WITHDRAWALS,
    "poi": POI,
}

# Keys and references that the quality checks assert.
PRIMARY_KEYS = {
    "locations": ["h3_09"],
    "transactions": ["transaction_pk"],
    "cash_withdrawals": ["h3_09", "customer_id"],
    "poi": ["id"],
}
FOREIGN_KEYS = [
    ("transactions", "h3_09", "locations", "h3_09"),
    ("cash_withdrawals", "h3_09", "locations", "h3_09"),
    ("poi", "h3_09_center", "locations", "h3_09"),
]

# The nine numeric features of the regression models, in the order the stored results use.
NUMERIC_FEATURES = [
    "total_transactions",
    "unique_mcc_count",
    "avg_transaction_amount",
    "std_transaction_amount",
    "max_time_slot",
    "min_time_slot",
    "location_transaction_count",
    "location_avg_amount",
    "location_unique_mcc_count",
]
