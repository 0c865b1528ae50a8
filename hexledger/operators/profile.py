"""Column profiles: describe, value lists, histograms, box-plot numbers, correlations, extents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexledger.operators import quantiles as Q
from hexledger.operators.rows import numeric_columns
from hexledger.session import counted_side


def _moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, count, mean, std, min, max) of numeric columns, in one pass."""
    names = [f"`{c}`" for c in columns]
    aggregated = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.count(n).alias("count"),
                    F.avg(n).alias("mean"),
                    F.stddev_samp(n).alias("std"),
                    F.min(F.col(n).cast("double")).alias("min"),
                    F.max(F.col(n).cast("double")).alias("max"),
                )
                for c, n in zip(columns, names)
            ]
        ).alias("stats")
    )
    return aggregated.select(F.inline("stats"))


def _quartiles(df: DataFrame, columns: list[str]) -> DataFrame:
    keys = ["column_name"]
    q = Q.quantiles(Q.long_values(df, columns), keys, [0.25, 0.5, 0.75])
    return q.select(*keys, F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"))


def describe_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, deviation, minimum, exact quartiles and maximum of each numeric column."""
    columns = numeric_columns(df) if columns is None else columns
    if not columns:
        numbers = ", ".join(f"{c} double" for c in ("mean", "std", "min", "max", "q25", "q50", "q75"))
        return df.sparkSession.createDataFrame([], f"column_name string, count long, {numbers}")
    return _moments(df, columns).join(_quartiles(df, columns), "column_name", "left")


def _frequencies(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, whole, number, text, n): how often each value occurs, null being a value of its own.

    Whole numbers and doubles are counted as such, values of any other type as text.
    """
    kinds = {"tinyint": "whole", "smallint": "whole", "int": "whole", "bigint": "whole", "double": "number"}
    types = dict(df.dtypes)

    def entry(c: str) -> Column:
        held = kinds.get(types[c], "text")
        fields = (("whole", "bigint"), ("number", "double"), ("text", "string"))
        values = [(F.col(f"`{c}`") if k == held else F.lit(None)).cast(t).alias(k) for k, t in fields]
        return F.struct(F.lit(c).alias("column_name"), *values)

    rows = df.select(F.inline(F.array(*[entry(c) for c in columns])))
    return rows.groupBy("column_name", "whole", "number", "text").agg(F.count("*").alias("n"))


def _extreme_values(freq: DataFrame, top_n: int) -> DataFrame:
    """The most and least frequent values of each column as text `value: n, …`.

    The rank filter lets Spark keep only `top_n` candidates per task before the shuffle.
    """

    def picked(order, name: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("column_name").orderBy(order, F.asc_nulls_first("value")))
        rows = freq.withColumn("rank", rank).filter(F.col("rank") <= top_n)
        entry = F.concat(F.coalesce("value", F.lit("null")), F.lit(": "), F.col("n"))
        return (
            rows.groupBy("column_name")
            .agg(F.array_sort(F.collect_list(F.struct("rank", entry.alias("entry")))).alias("e"))
            .select("column_name", F.concat_ws(", ", "e.entry").alias(name))
        )

    return picked(F.desc("n"), "top_values").join(picked(F.asc("n"), "bottom_values"), "column_name")


def column_profile(df: DataFrame, top_n: int = 3) -> DataFrame:
    """One row per column: type, different values, count, numeric summary, most and least frequent
    values. For text columns `median` holds the most frequent value (smallest on ties)."""
    columns = df.columns
    numeric = numeric_columns(df)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    # The branches below read one shuffle of counted values; text is made of these, after it.
    shown = F.coalesce(F.col("whole").cast("string"), F.col("number").cast("string"), "text")
    freq = _frequencies(df, columns).select("column_name", shown.alias("value"), "n")
    counted = freq.filter("value IS NOT NULL").groupBy("column_name").agg(
        F.count("*").alias("n_unique"),
        F.sum("n").alias("count"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"),
    )
    numbers = describe_numeric(df, numeric).drop("count")
    dtype = F.create_map(*[F.lit(x) for c in columns for x in (c, types[c])])
    return (
        _extreme_values(freq, top_n)
        .join(counted, "column_name", "left")
        .join(numbers, "column_name", "left")
        .select(
            "column_name",
            F.try_element_at(dtype, F.col("column_name")).alias("dtype"),
            F.coalesce("n_unique", F.lit(0)).alias("n_unique"),
            F.coalesce("count", F.lit(0)).alias("count"),
            "mean",
            "std",
            "min",
            "q25",
            F.when(F.col("column_name").isin(numeric), F.col("q50").cast("string"))
            .otherwise(F.col("mode"))
            .alias("median"),
            "q75",
            "max",
            "top_values",
            "bottom_values",
        )
    )


def format_profile(profile: DataFrame, places: int = 4) -> DataFrame:
    """Numbers as report text: fractions with `places` decimals, whole numbers with separators."""
    shown = []
    for field in profile.schema.fields:
        kind = field.dataType.typeName()
        if kind in ("double", "float"):
            shown.append(F.regexp_replace(F.format_number(field.name, places), ",", "").alias(field.name))
        elif kind in ("long", "integer", "short"):
            shown.append(F.format_number(field.name, 0).alias(field.name))
        else:
            shown.append(F.col(field.name))
    return profile.select(*shown)


def histogram(df: DataFrame, columns: list[str], bins: int = 45, log1p: bool = False) -> DataFrame:
    """Equal-width counts (column_name, bin 0..bins-1, bin_low, n); the maximum is in the last bin.

    With `log1p` the logarithm of 1 + value is counted, for columns with any positive value.
    Empty bins have no row.
    """
    values = {c: F.col(f"`{c}`").cast("double") for c in columns}
    if log1p:
        values = {c: F.log1p(v) for c, v in values.items()}
    # One row of bounds; then every row is binned where it is read, and only counts per bin are shuffled.
    bounds = df.agg(
        F.struct(*[f(v).alias(f"{c}_{n}") for c, v in values.items() for n, f in (("lo", F.min), ("hi", F.max))])
    ).scalar()

    def placed(c: str, v: Column) -> Column:
        lo, hi = bounds[f"{c}_lo"], bounds[f"{c}_hi"]
        index = F.when(hi == lo, 0).otherwise(F.least(F.floor((v - lo) / ((hi - lo) / bins)), F.lit(bins - 1)))
        counts = v.isNotNull() & (hi > 0) if log1p else v.isNotNull()
        return F.struct(
            F.lit(c).alias("column_name"), F.when(counts, index).cast("int").alias("bin"), lo.alias("lo"), hi.alias("hi")
        )

    rows = df.select(F.inline(F.array(*[placed(c, v) for c, v in values.items()]))).where("bin IS NOT NULL")
    width = (F.col("hi") - F.col("lo")) / bins
    return (
        rows.groupBy("column_name", "bin", "lo", "hi")
        .agg(F.count("*").alias("n"))
        .select("column_name", "bin", (F.col("lo") + F.col("bin") * width).alias("bin_low"), "n")
    )


def customer_histograms(tx: DataFrame, customer: str = "customer_id", bins: int = 45) -> DataFrame:
    """How transactions spread over customer ids, and how many customers have how many transactions.

    The rows of `histogram` for the columns `customer_id` (transactions) and `transactions` (customers).
    """
    per_customer = tx.groupBy(customer).agg(F.count("*").alias("transactions"))
    return histogram(tx, [customer], bins).unionByName(histogram(per_customer, ["transactions"], bins))


def boxplot_stats(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Quartiles, whiskers at the last values within 1.5 interquartile ranges, outlier count."""
    keys = [*(by or []), "column_name"]
    values = Q.long_values(df, columns, by)
    q = Q.quantiles(values, keys, [0.25, 0.5, 0.75])
    fences = q.select(
        *keys,
        F.col("q")[0].alias("q1"),
        F.col("q")[1].alias("median"),
        F.col("q")[2].alias("q3"),
        (F.col("q")[0] - 1.5 * (F.col("q")[2] - F.col("q")[0])).alias("lo_fence"),
        (F.col("q")[2] + 1.5 * (F.col("q")[2] - F.col("q")[0])).alias("hi_fence"),
    )
    within = (F.col("value") >= F.col("lo_fence")) & (F.col("value") <= F.col("hi_fence"))
    return (
        Q.on_keys(values, counted_side(fences, "fences"), keys)
        .groupBy(*keys, "q1", "median", "q3")
        .agg(
            F.min(F.when(within, F.col("value"))).alias("whisker_low"),
            F.max(F.when(within, F.col("value"))).alias("whisker_high"),
            F.count_if(~within).alias("outliers"),
        )
    )


# Partial products of tasks are added up in so many groups first.
_SUM_GROUPS = 64
_LINES = "part int, line int, entries array<double>"
# A variance below this share of the squares is what rounding leaves of a constant.
_ROUNDING = 1e-12


def _pair_products(values: np.ndarray, present: np.ndarray) -> np.ndarray:
    """For all pairs of columns over rows where both are present: rows, sums and squares of the first column,
    products, and rows in which the first column is not a finite number. One matrix product each."""
    odd = present & ~np.isfinite(values)
    x, m = np.where(present & ~odd, values, 0.0), present.astype(float)
    return np.vstack((m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x, odd.astype(float).T @ m))


def _correlations(products: np.ndarray) -> list[float | None]:
    """The correlation of every pair, row by row; null without variance, NaN where a number is not finite."""
    n, sums, squares, crossed, odd = products.reshape(5, products.shape[1], -1)
    rows = np.maximum(n, 1.0)
    varied = squares - sums**2 / rows
    known = (n > 1) & (varied > _ROUNDING * squares) & (varied.T > _ROUNDING * squares.T)
    shared = crossed - sums * sums.T / rows
    corr = np.clip(shared / np.sqrt(np.where(known, varied * varied.T, 1.0)), -1.0, 1.0)
    corr[(odd + odd.T) > 0] = np.nan
    known |= (odd + odd.T) > 0
    return [float(c) if k else None for c, k in zip(corr.ravel(), known.ravel(), strict=True)]


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair of numeric columns over rows where both are present.

    Every task multiplies its rows, less a mean of each column, into five matrices; only these are shuffled and
    added up, so the plan does not grow with the number of pairs. A column with itself is 1 unless it is constant.
    """
    columns = columns or numeric_columns(df)
    doubles = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    finite = [F.when(F.abs(c) < float("inf"), F.col(c)) for c in doubles.columns]
    ends = [
        F.struct(F.avg(f).alias("mean"), F.min(c).alias("lo"), F.max(c).alias("hi"))
        for f, c in zip(finite, doubles.columns, strict=True)
    ]
    about = doubles.agg(*[e.alias(f"e{i}") for i, e in enumerate(ends)]).first() if columns else ()
    # A constant is its own mean exactly, so that nothing is left of it.
    shift = np.array([(e.lo if e.lo == e.hi else e.mean) or 0.0 for e in about])
    shift = np.where(np.isfinite(shift), shift, 0.0)
    varies = [e.lo is not None and not e.lo == e.hi for e in about]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((5 * len(columns), len(columns)))
        for batch in batches:
            read = [pc.fill_null(c, 0.0).to_numpy(zero_copy_only=False) for c in batch.columns]
            held = [c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns]
            total += _pair_products(np.column_stack(read) - shift, np.column_stack(held))
        lines = np.arange(len(total), dtype=np.int32)
        part = np.full(len(total), TaskContext.get().partitionId(), dtype=np.int32)
        entries = pa.array(list(total), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(lines), entries], ["part", "line", "entries"])

    def add(table: pa.Table) -> pa.Table:
        total = np.sum(table.sort_by("part")["entries"].to_pylist(), axis=0)
        first = [pa.array([table[c][0].as_py()], pa.int32()) for c in ("part", "line")]
        return pa.table([*first, pa.array([total], pa.list_(pa.float64()))], ["part", "line", "entries"])

    def finish(table: pa.Table) -> pa.Table:
        corr = _correlations(np.array(table.sort_by("line")["entries"].to_pylist()))
        for i, moves in enumerate(varies):
            corr[i * (len(columns) + 1)] = 1.0 if moves else None
        pairs = [[a for a in columns for _ in columns], [b for _ in columns for b in columns]]
        return pa.table([*map(pa.array, pairs), pa.array(corr, pa.float64())], ["col_a", "col_b", "corr"])

    schema = "col_a string, col_b string, corr double"
    if not columns:
        return df.sparkSession.createDataFrame([], schema)
    parts = doubles.mapInArrow(multiply, _LINES)
    summed = parts.groupBy("line", F.col("part") % _SUM_GROUPS).applyInArrow(lambda _, t: add(t), _LINES)
    summed = summed.groupBy("line").applyInArrow(lambda _, t: add(t), _LINES)
    return summed.groupBy().applyInArrow(finish, schema)


def bounding_box(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Extent and mean centre of a point set."""
    return df.agg(
        F.min(lon).alias("min_lon"),
        F.min(lat).alias("min_lat"),
        F.max(lon).alias("max_lon"),
        F.max(lat).alias("max_lat"),
        F.avg(lat).alias("center_lat"),
        F.avg(lon).alias("center_lon"),
    )
