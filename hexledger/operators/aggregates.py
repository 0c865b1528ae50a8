"""Reports and summaries over transactions, withdrawals, cells and points of interest.

Aggregates shuffle partial results, never rows, so a key that holds much of the table is safe. The exception
are groups by customer and cell, nearly as many as rows: partial results would fill a task's memory and save
nothing, so the rows are dealt by the group to as many tasks as they are worth.
Many-to-many counts are taken as products of per-key counts instead of joining the rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexledger.functions import cells
from hexledger.session import counted_side, tasks_for


def customer_stats(tx: DataFrame) -> DataFrame:
    """Per customer. `unique_mcc_count` keeps its published meaning, the number of non-null codes;
    `distinct_mcc_count` is the number of different ones."""
    return tx.groupBy("customer_id").agg(
        F.count("*").alias("total_transactions"),
        F.count("mcc_code").alias("unique_mcc_count"),
        F.avg("sum").alias("avg_transaction_amount"),
        F.stddev_samp("sum").alias("std_transaction_amount"),
        F.max("datetime_id").alias("max_time_slot"),
        F.min("datetime_id").alias("min_time_slot"),
        F.count_distinct("mcc_code").alias("distinct_mcc_count"),
    )


def customer_cell_stats(tx: DataFrame) -> DataFrame:
    keys = ["customer_id", "h3_09"]
    dealt = tx.select(*keys, "sum", "mcc_code").repartition(tasks_for(tx), *keys)
    return dealt.groupBy(*keys).agg(
        F.count("*").alias("location_transaction_count"),
        F.avg("sum").alias("location_avg_amount"),
        F.count("mcc_code").alias("location_unique_mcc_count"),
    )


def overall_totals(tx: DataFrame) -> DataFrame:
    return tx.agg(
        F.count("*").alias("total_transactions"),
        F.sum(F.col("sum").cast("double")).alias("overall_sum"),
    )


def cell_totals(tx: DataFrame, locations: DataFrame) -> DataFrame:
    """Amount per cell to two places, with the cell's centre; aggregated before the join."""
    totals = tx.groupBy("h3_09").agg(
        F.round(F.sum(F.col("sum").cast("double")), 2).cast("decimal(15,2)").alias("total_sum")
    )
    return totals.join(locations.select("h3_09", "lat", "lon"), "h3_09")


def withdraw_rate(tx: DataFrame, withdrawals: DataFrame) -> DataFrame:
    """Rows of transactions ⟕ withdrawals that found a withdrawal, and all rows.

    Both sides are counted per (customer, cell) first: n rows meeting m withdrawals make n·m
    matched rows, and n rows meeting none stay n rows.
    """
    keys = ["customer_id", "h3_09"]
    tasks = tasks_for(tx)
    left = tx.select(*keys).repartition(tasks, *keys).groupBy(*keys).agg(F.count("*").alias("n"))
    right = withdrawals.select(*keys).repartition(tasks, *keys).groupBy(*keys).agg(F.count("*").alias("m"))
    joined = left.join(right, keys, "left")
    return joined.agg(
        F.coalesce(F.sum(F.col("n") * F.coalesce("m", F.lit(0))), F.lit(0)).alias("withdraw_tx"),
        F.coalesce(F.sum(F.col("n") * F.coalesce("m", F.lit(1))), F.lit(0)).alias("total_tx"),
    )


def word_frequency(places: DataFrame, tx: DataFrame) -> DataFrame:
    """How many (place, transaction) pairs share a cell, per place name.

    Equal to joining the rows and counting, but the join meets one row per cell on the
    transaction side and one row per (cell, name) on the place side.
    """
    names = places.groupBy(F.col("h3_09_center").alias("h3_09"), "place_name").agg(F.count("*").alias("n_places"))
    busy = tx.groupBy("h3_09").agg(F.count("*").alias("n_tx"))
    return (
        names.join(busy, "h3_09")
        .groupBy(F.col("place_name").alias("text_label"))
        .agg(F.sum(F.col("n_places") * F.col("n_tx")).alias("size_metric"))
    )


def tags_per_cell(places: DataFrame) -> DataFrame:
    """(h3_09, place_name, name_count): the names of each cell, one row per name whatever their number."""
    named = places.filter("place_name IS NOT NULL")
    return named.groupBy(F.col("h3_09_center").alias("h3_09"), "place_name").agg(F.count("*").alias("name_count"))


def cell_tag_keys(places: DataFrame) -> DataFrame:
    """(h3_09, tags_key): a fixed-size key, equal for cells with equal names in equal numbers.

    The number of names and the sum of the first 60 bits of their md5. Stands for the joined text of a cell,
    which would be one value of unbounded size.
    """
    bits = F.conv(F.substring(F.md5(F.col("place_name").cast("binary")), 1, 15), 16, 10).cast("decimal(20,0)")
    return (
        places.filter("place_name IS NOT NULL")
        .groupBy(F.col("h3_09_center").alias("h3_09"))
        .agg(F.concat_ws(":", F.count("*"), F.sum(bits)).alias("tags_key"))
    )


def top_center_names(places: DataFrame, k: int = 30) -> DataFrame:
    """The names and their counts at the `k` centres with the most places, one row per name."""
    counts = places.groupBy("h3_09_center", "place_name").agg(F.count("*").alias("name_count"))
    top = (
        counts.groupBy("h3_09_center")
        .agg(F.sum("name_count").alias("center_count"))
        .orderBy(F.desc("center_count"), F.asc("h3_09_center"))
        .limit(k)
    )
    return counts.join(F.broadcast(top), "h3_09_center")


def customer_summary(tx: DataFrame) -> DataFrame:
    """Per customer; rows are grouped by cell and code first, so that each different one is met once a task."""
    keys = ["customer_id", "h3_09"]
    dealt = tx.select(*keys, "mcc_code", "count", "sum").repartition(tasks_for(tx), *keys)
    visits = dealt.groupBy(*keys).agg(
        F.sum(F.col("count").cast("long")).alias("count"),
        F.sum(F.col("sum").cast("double")).alias("sum"),
    )
    totals = visits.groupBy("customer_id").agg(
        F.sum("count").alias("count"), F.sum("sum").alias("sum"), F.count("h3_09").alias("n_cells")
    )
    codes = dealt.groupBy(F.col("customer_id").alias("_customer"), "mcc_code").agg(F.lit(1))
    counted = codes.groupBy("_customer").agg(F.count("mcc_code").alias("n_mcc"))
    return totals.join(counted, F.col("customer_id").eqNullSafe(F.col("_customer"))).drop("_customer")


def location_summary(tx: DataFrame) -> DataFrame:
    return tx.groupBy("h3_09").agg(
        F.sum(F.col("count").cast("long")).alias("count"),
        F.sum(F.col("sum").cast("double")).alias("sum"),
        F.count_distinct("customer_id").alias("n_customers"),
    )


def value_counts(df: DataFrame, column: str, with_nulls: bool = True) -> DataFrame:
    """Rows per value; the null group is kept unless `with_nulls` is false."""
    rows = df if with_nulls else df.filter(F.col(column).isNotNull())
    return rows.groupBy(column).agg(F.count("*").alias("n"))


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table, and a last row `total`."""
    counts = reduce(
        lambda a, b: a.unionByName(b),
        [df.agg(F.count("*").alias("n_rows")).withColumn("table_name", F.lit(name)) for name, df in tables.items()],
    )
    total = counts.agg(F.sum("n_rows").alias("n_rows")).withColumn("table_name", F.lit("total"))
    return counts.unionByName(total).select("table_name", "n_rows")


def parent_cell_avg(tx: DataFrame, resolution: int = 8) -> DataFrame:
    """Every transaction with the mean amount of its ancestor cell.

    Aggregate and join back rather than a window, which would hold a whole cell in one task.
    """
    parent = f"h3_{resolution:02d}"
    rows = tx.withColumn(parent, cells.cell_to_parent(F.col("h3_09"), resolution))
    means = rows.groupBy(parent).agg(F.avg("sum").alias("avg_sum"))
    return rows.join(counted_side(means, "parent_cells"), parent, "left")


def parent_cell_totals(tx: DataFrame, resolution: int) -> DataFrame:
    """Transactions and amount per ancestor cell."""
    parent = cells.cell_to_parent(F.col("h3_09"), resolution).alias("parent_cell")
    return tx.groupBy(parent).agg(
        F.count("*").alias("n_transactions"), F.sum(F.col("sum").cast("double")).alias("total_sum")
    )


def atm_density(tx: DataFrame, atm_cells: DataFrame, resolution: int = 8) -> DataFrame:
    """Every transaction with the number of ATM cells under its ancestor cell, 0 where there are none."""
    parent = f"h3_{resolution:02d}"
    density = atm_cells.groupBy(cells.cell_to_parent(F.col("h3_09"), resolution).alias(parent)).agg(
        F.count("*").alias("atm_count")
    )
    rows = tx.withColumn(parent, cells.cell_to_parent(F.col("h3_09"), resolution))
    return rows.join(counted_side(density, "density"), parent, "left").na.fill(0, subset=["atm_count"])


def empty_token_count(df: DataFrame, n_tokens: str = "n_tokens") -> DataFrame:
    """Rows without any token; `n_tokens` is their number, null where there are none."""
    return df.agg(F.count_if(F.coalesce(F.col(n_tokens), F.lit(0)) == 0).alias("empty_tokens"))


def cell_census(df: DataFrame, column: str = "h3_09") -> DataFrame:
    """Rows per resolution, the invalid ids counted in a group of their own (null resolution)."""
    valid = cells.cell_is_valid(F.col(column))
    return df.groupBy(
        valid.alias("is_valid"), F.when(valid, cells.cell_resolution(F.col(column))).alias("resolution")
    ).agg(F.count("*").alias("n"))


def best_formats(results: DataFrame) -> DataFrame:
    """Best compression and fastest read per table and overall, failed rows left out.

    Ties go to the later row text for compression (a reversed sort) and the earlier one for reads.
    """
    ok = results.filter("status <> 'FAILED'")
    text = F.concat_ws(
        ",", "table", "format", "codec", "size_mb", "original_size_mb", "compression_ratio",
        "import_time_sec", "read_time_sec",
    )
    ok = ok.withColumn("_text", text).withColumn("_row", F.struct("table", "format", "codec"))
    picks = [
        F.max_by("_row", F.struct("compression_ratio", "_text")).alias("compression"),
        F.min_by("_row", F.struct("read_time_sec", "_text")).alias("read"),
    ]
    per_table = ok.groupBy(F.col("table").alias("scope")).agg(*picks)
    overall = ok.agg(*picks).select(F.lit("overall").alias("scope"), "compression", "read")
    long = per_table.unionByName(overall).select(
        "scope",
        F.explode(
            F.array(
                F.struct(F.lit("compression").alias("kind"), F.col("compression").alias("best")),
                F.struct(F.lit("read").alias("kind"), F.col("read").alias("best")),
            )
        ).alias("pick"),
    )
    return long.filter("pick.best IS NOT NULL").select(
        "scope", "pick.kind", F.col("pick.best.table").alias("table"), "pick.best.format", "pick.best.codec"
    )
