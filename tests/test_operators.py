from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from hexledger.operators import aggregates, features, joins, metrics, profile, quality, rows, sets
from hexledger.operators import quantiles as Q
from hexledger.session import materialize, tasks_for


def tuples(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_withdraw_rate_counts_like_a_left_join(spark):
    tx = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a"), (None, "a")], "customer_id long, h3_09 string")
    w = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "a")], "customer_id long, h3_09 string")
    joined = tx.join(w.withColumn("hit", F.lit(1)), ["customer_id", "h3_09"], "left")
    want = joined.agg(F.count("hit"), F.count("*")).first()
    got = aggregates.withdraw_rate(tx, w).first()
    assert tuple(got) == tuple(want) == (4, 7)


def test_withdraw_rate_of_nothing(spark):
    empty = spark.createDataFrame([], "customer_id long, h3_09 string")
    assert tuple(aggregates.withdraw_rate(empty, empty).first()) == (0, 0)


def test_word_frequency_equals_the_row_join(spark, tables):
    joined = tables.places.join(
        tables.transactions.select(F.col("h3_09").alias("h3_09_center")), "h3_09_center"
    )
    want = {r["place_name"]: r["n"] for r in joined.groupBy("place_name").agg(F.count("*").alias("n")).collect()}
    got = {r["text_label"]: r["size_metric"] for r in aggregates.word_frequency(tables.places, tables.transactions).collect()}
    assert got == want


def test_names_of_a_large_cell_are_rows(spark):
    names = [(i, "hot", f"name {i % 50}") for i in range(2000)] + [(9999, "cold", "only one"), (1, "cold", None)]
    places = spark.createDataFrame(names, "id long, h3_09_center string, place_name string")
    got = {(r["h3_09"], r["place_name"]): r["name_count"] for r in aggregates.tags_per_cell(places).collect()}
    assert got == {("hot", f"name {i}"): 40 for i in range(50)} | {("cold", "only one"): 1}


def test_summed_tag_vectors_equal_the_vector_of_the_joined_text(spark, tables):
    summed = {r["h3_09"]: r["tags_features"].toArray() for r in features.cell_tag_vectors(tables.places).collect()}
    joined = tables.places.groupBy(F.col("h3_09_center").alias("h3_09")).agg(
        F.concat_ws(" ", F.collect_list("place_name")).alias("text")
    )
    whole = features.hashing_tf(features.tokenize(joined, "text"), "tags_tokens")
    for r in whole.collect():
        assert np.array_equal(summed[r["h3_09"]], r["tags_features"].toArray())


def test_tag_keys_follow_the_joined_texts(spark):
    cells = {"a": ["x", "y", "x"], "b": ["x", "x", "y"], "c": ["x", "y"], "d": ["xy"], "e": ["x", "y", "y"]}
    rows_ = [(n, c, name) for c, names in cells.items() for n, name in enumerate(names)]
    places = spark.createDataFrame(rows_, "id long, h3_09_center string, place_name string")
    keys = {r["h3_09"]: r["tags_key"] for r in aggregates.cell_tag_keys(places).collect()}
    assert keys["a"] == keys["b"] and len(set(keys.values())) == 4


def test_rows_do_not_depend_on_the_names_of_a_cell(spark):
    places = spark.createDataFrame(
        [(i, "hot", f"name {i}") for i in range(10_000)] + [(1, "cold", "one")],
        "id long, h3_09_center string, place_name string",
    )
    pairs = spark.createDataFrame([(1, "hot"), (1, "cold"), (1, "bare"), (2, "bare")], "customer_id long, h3_09 string")
    got = features.with_tag_key(pairs, places, "Unknown").collect()
    assert len(got) == 4 and {r["tags_key"] for r in got if r["h3_09"] == "bare"} == {"Unknown"}
    assert all(len(r["tags_key"]) < 40 for r in got)


def test_unknown_tag_vector(spark, tables):
    vectors = features.cell_tag_vectors(tables.places)
    cells = spark.createDataFrame([("nowhere",)], "h3_09 string")
    got = features.with_tag_vectors(cells, vectors).first()["tags_features"].toArray()
    text = spark.createDataFrame([("Unknown",)], "t string")
    want = features.hashing_tf(features.tokenize(text, "t"), "tags_tokens").first()["tags_features"].toArray()
    assert np.array_equal(got, want)


def test_training_rows_fill_features_but_drop_missing_labels(spark):
    w = spark.createDataFrame([(1, "a"), (2, "a"), (1, "gone")], "customer_id long, h3_09 string")
    tx = spark.createDataFrame(
        [(1, "a", 5.0, 1, 2), (1, "b", 7.0, 3, 2)],
        "customer_id long, h3_09 string, sum double, datetime_id short, mcc_code short",
    )
    locations = spark.createDataFrame([("a", 55.0, 37.0)], "h3_09 string, lat double, lon double")
    got = {r["customer_id"]: r for r in features.training_rows(w, tx, locations).collect()}
    assert set(got) == {1, 2}
    assert got[1]["total_transactions"] == 2 and got[1]["location_transaction_count"] == 1
    assert got[2]["total_transactions"] == 0 and got[2]["std_transaction_amount"] == 0.0


def test_fill_null_numbers_leaves_text(spark):
    df = spark.createDataFrame([(None, None)], "n double, t string")
    assert tuple(rows.fill_null_numbers(df).first()) == (0.0, None)


def test_amount_cap_keeps_the_cap_and_drops_null(spark):
    df = spark.createDataFrame([(200000.0,), (200000.5,), (None,)], "sum double")
    assert tuples(rows.amount_cap(df), "sum") == [(200000.0,)]


def test_surrogate_key_is_consecutive_in_order(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5003).alias("k"))
    keyed = rows.surrogate_key(df, ["k"], "pk").orderBy("pk").collect()
    assert [r["pk"] for r in keyed] == list(range(5000))
    assert [r["k"] for r in keyed] == sorted(r["k"] for r in keyed)


def test_key_split_does_not_depend_on_partitioning(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a, b = rows.key_split(df, ["k"])
    c, _ = rows.key_split(df.repartition(13), ["k"])
    assert a.count() + b.count() == 1000
    assert tuples(a, "k") == tuples(c, "k")
    assert 750 < a.count() < 850


def test_inclusion_rules_for_nulls(spark):
    def frame(*values):
        return spark.createDataFrame([(v,) for v in values], "v string")

    def included(a, b):
        return joins.inclusion_check(a, b, "v").first()["included"]

    assert included(frame("a", "b"), frame("a", "b", "c"))
    assert not included(frame("a", "x"), frame("a"))
    assert not included(frame("a", None), frame("a"))
    assert included(frame("a", None), frame("a", None))
    assert included(frame("a"), frame("a", None))


def test_value_counts_and_duplicates(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "v string")
    assert {r["v"]: r["n"] for r in aggregates.value_counts(df, "v").collect()} == {"a": 2, None: 2, "b": 1}
    assert {r["v"]: r["n"] for r in aggregates.value_counts(df, "v", False).collect()} == {"a": 2, "b": 1}
    assert sets.has_duplicates(df).first()[0]
    assert not sets.has_duplicates(df.distinct()).first()[0]


def test_best_per_group_keeps_one_candidate_per_task(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    best = sets.best_per_group(df, ["g"], [F.desc("id")])
    assert tuples(best, "g", "id") == [(0, 999), (1, 997), (2, 998)]
    assert "WindowGroupLimit" in best._jdf.queryExecution().executedPlan().toString()


def test_std_rule(spark):
    df = spark.createDataFrame([(None, 1), (1.0, 2), (None, 3), (2.0, 1)], "std double, count short")
    assert quality.std_null_violations(df).count() == 2


@pytest.mark.parametrize("size", [1, 2, 5, 1000])
def test_quantiles_match_numpy(spark, size):
    rng = np.random.default_rng(size)
    data = {"a": rng.normal(size=size).round(2), "b": rng.integers(0, 3, size=size).astype(float)}
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(data["a"], data["b"])], "a double, b double")
    ordered = Q.long_values(df, ["a", "b"])
    got = {r["column_name"]: r["q"] for r in Q.quantiles(ordered, ["column_name"], [0.0, 0.25, 0.5, 0.9, 1.0]).collect()}
    for name, values in data.items():
        assert got[name] == pytest.approx(np.quantile(values, [0.0, 0.25, 0.5, 0.9, 1.0]))


def test_quantiles_of_a_hot_value_and_of_nulls_only(spark):
    df = spark.createDataFrame([(1.0, None)] * 500 + [(2.0, None), (0.0, None)], "a double, b double")
    ordered = Q.long_values(df, ["a", "b"])
    got = {r["column_name"]: r["q"] for r in Q.quantiles(ordered, ["column_name"], [0.0, 0.5, 1.0]).collect()}
    assert got == {"a": [0.0, 1.0, 2.0]}


def test_quantiles_of_numbers_that_are_far_apart(spark, monkeypatch):
    """Magnitudes from the smallest to the largest double, both infinities, NaN last, few bins, null keys."""
    monkeypatch.setattr(Q, "BINS", 64)
    inf, nan = float("inf"), float("nan")
    wide = [-inf, -1.7e308, -1.0, -5e-324, 0.0, 5e-324, 1e-300, 1e-9, 1.0, 1.0, 3e9, 1.7e308, inf]
    rows = [("wide", v) for v in wide] + [(None, float(v)) for v in range(5)]
    rows += [("ends", -inf), ("ends", inf), ("ends", inf), ("odd", nan), ("odd", 1.0), ("odd", nan)]
    values = spark.createDataFrame(rows, "k string, value double")
    shares = [i / 12 for i in range(13)]
    got = {r["k"]: r["q"] for r in Q.quantiles(values, ["k"], shares).collect()}
    assert got["wide"] == wide
    assert got[None] == pytest.approx([i / 3 for i in range(13)])
    assert (got["ends"][0], got["ends"][6], got["ends"][12]) == (-inf, inf, inf)
    assert got["odd"][0] == 1.0 and np.isnan(got["odd"][6]) and np.isnan(got["odd"][12])


def test_quantiles_write_no_values(spark, monkeypatch):
    """What is written is a row per wanted rank and open interval, however many values there are."""
    written = []

    def counting(df, name):
        stored = materialize(df, name)
        written.append(stored.count())
        return stored

    monkeypatch.setattr(Q, "materialize", counting)
    for size in (100, 50_000):
        df = spark.range(size).select(F.sqrt("id").alias("a"), F.expr("id % 7").alias("b"))
        q = {r["column_name"]: r["q"] for r in Q.quantiles(Q.long_values(df, ["a", "b"]), ["column_name"], [0.5]).collect()}
        assert q["a"][0] == pytest.approx(np.median(np.sqrt(np.arange(size))))
    # Two columns with one rank from below and one from above.
    assert max(written) == 4 and len(written) <= 8


def test_profile_keeps_the_types_of_values(spark):
    """Whole numbers beyond 2^53 stay apart; other types are profiled as text; text alone has no numbers."""
    rows = [(2**53, 0.1, True, "x"), (2**53 + 1, 0.1, None, "x"), (None, float("nan"), False, None)]
    df = spark.createDataFrame(rows, "w long, d double, b boolean, t string")
    got = {r["column_name"]: r for r in profile.column_profile(df).collect()}
    assert {c: r["n_unique"] for c, r in got.items()} == {"w": 2, "d": 2, "b": 2, "t": 1}
    assert got["w"]["top_values"] == "null: 1, 9007199254740992: 1, 9007199254740993: 1"
    assert got["d"]["top_values"] == "0.1: 2, NaN: 1"
    assert got["b"]["median"] == "false"
    only = profile.column_profile(df.select("t")).first()
    assert (only["median"], only["mean"], only["top_values"]) == ("x", None, "x: 2, null: 1")


def test_boxplot_by_group(spark):
    df = spark.createDataFrame([(0, float(v)) for v in [1, 2, 3, 4, 100]] + [(1, 5.0)], "g int, v double")
    got = {r["g"]: r for r in profile.boxplot_stats(df, ["v"], ["g"]).collect()}
    assert (got[0]["q1"], got[0]["median"], got[0]["q3"]) == (2.0, 3.0, 4.0)
    assert (got[0]["whisker_low"], got[0]["whisker_high"], got[0]["outliers"]) == (1.0, 4.0, 1)
    assert (got[1]["median"], got[1]["outliers"]) == (5.0, 0)


def test_histogram_of_a_constant_and_log_form(spark):
    df = spark.createDataFrame([(3.0, 0.0), (3.0, 0.0)], "c double, z double")
    got = {r["column_name"]: (r["bin"], r["n"]) for r in profile.histogram(df, ["c", "z"]).collect()}
    assert got == {"c": (0, 2), "z": (0, 2)}
    # A column without positive values has no logarithmic histogram.
    assert [r["column_name"] for r in profile.histogram(df, ["c", "z"], log1p=True).collect()] == ["c"]


def test_profile_counts_nulls_as_a_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "t string")
    row = profile.column_profile(df.withColumn("n", F.lit(1.0))).filter("column_name = 't'").first()
    assert (row["dtype"], row["n_unique"], row["count"], row["median"]) == ("string", 2, 4, "a")
    assert row["top_values"] == "a: 2, b: 2, null: 1"
    assert row["bottom_values"] == "null: 1, a: 2, b: 2"


def test_classification_metrics(spark):
    pairs = [(0.0, 0.0)] * 3 + [(0.0, 1.0)] + [(1.0, 1.0)] * 2 + [(2.0, 0.0)] + [(1.0, 3.0)]
    df = spark.createDataFrame(pairs, "label double, prediction double")
    row = metrics.classification_report(df).first()
    for name, column in (("accuracy", "accuracy"), ("f1", "weighted_f1")):
        assert row[column] == pytest.approx(MulticlassClassificationEvaluator(metricName=name).evaluate(df))
    # Class 2 is never predicted, class 3 is no label.
    f1 = [2 * 0.75 * 0.75 / 1.5, 2 * (2 / 3) ** 2 / (4 / 3), 0.0]
    assert row["macro_f1"] == pytest.approx(sum(f1) / 3)


def test_best_formats_with_failures_and_ties(spark):
    # A published storage trial: ratio and read time per table, format and codec.
    trial = [
        ("locations", "avro", "Gzip", 0.07, 0.70, 10.65, 14, 16),
        ("locations", "avro", "Snappy", 0.10, 0.70, 6.87, 15, 12),
        ("locations", "avro", "Bzip2", 0.06, 0.70, 11.97, 16, 13),
        ("locations", "parquet", "Gzip", 0.06, 0.70, 10.87, 16, 12),
        ("locations", "parquet", "Snappy", 0.10, 0.70, 6.79, 17, 12),
        ("locations", "parquet", "Bzip2", None, None, None, 3, None),
        ("cash_withdrawals", "avro", "Bzip2", 0.64, 16.09, 25.04, 17, 13),
        ("cash_withdrawals", "parquet", "Gzip", 0.66, 16.09, 24.43, 16, 12),
        ("cash_withdrawals", "parquet", "Snappy", 0.81, 16.09, 19.86, 16, 12),
    ]
    schema = (
        "table string, format string, codec string, size_mb double, original_size_mb double, "
        "compression_ratio double, import_time_sec double, read_time_sec double"
    )
    df = spark.createDataFrame([(*r[:6], float(r[6]), None if r[7] is None else float(r[7])) for r in trial], schema)
    df = df.withColumn("status", F.when(F.col("size_mb").isNull(), "FAILED").otherwise("OK"))
    got = {(r["scope"], r["kind"]): (r["table"], r["format"], r["codec"]) for r in aggregates.best_formats(df).collect()}
    assert got[("locations", "compression")] == ("locations", "avro", "Bzip2")
    assert got[("overall", "compression")] == ("cash_withdrawals", "avro", "Bzip2")
    assert got[("overall", "read")] == ("cash_withdrawals", "parquet", "Gzip")
    assert got[("locations", "read")] == ("locations", "avro", "Snappy")


def test_suffix_join(spark):
    a = spark.createDataFrame([(1, 5.0, "l")], "k int, lat double, only string")
    b = spark.createDataFrame([(1, 6.0)], "k int, lat double")
    got = joins.attach_with_suffixes(a, b, "k")
    assert got.columns == ["k", "lat_x", "only", "lat_y"]
    assert tuple(got.first()) == (1, 5.0, "l", 6.0)


def test_correlations_over_present_pairs(spark):
    """Pair by pair against numpy: nulls, constants, far means, numbers that are not finite."""
    import math
    import random

    dice, rows = random.Random(2), []
    for k in range(300):
        a = dice.gauss(0, 1)
        rows.append((
            a if k % 7 else None,
            1e9 + a + dice.gauss(0, 1) if k % 5 else None,
            5.5,
            float(k % 3),
            2.5 if k % 7 else float(k),  # constant where the first column is present
            float("nan") if k == 20 else a * 2,
            None,
        ))
    names = ["a", "far", "same", "w.x", "partly", "odd", "none"]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names)).repartition(5)
    got = {(r.col_a, r.col_b): r["corr"] for r in profile.correlation_matrix(df).collect()}
    assert set(got) == {(a, b) for a in names for b in names}
    for i, a in enumerate(names):
        assert got[a, a] == (None if a in ("same", "none") else 1.0)
        for b in names[i + 1 :]:
            both = [(r[i], r[names.index(b)]) for r in rows if r[i] is not None and r[names.index(b)] is not None]
            assert got[a, b] == got[b, a] or math.isnan(got[a, b])
            if any(math.isnan(x + y) for x, y in both):
                assert math.isnan(got[a, b])
            elif len(both) < 2 or any(len({p[k] for p in both}) == 1 for k in (0, 1)):
                assert got[a, b] is None, (a, b)
            else:
                assert math.isclose(got[a, b], np.corrcoef(np.array(both).T)[0, 1], abs_tol=1e-6), (a, b)
    assert math.isnan(got["a", "odd"]) and got["a", "partly"] is None and got["a", "same"] is None
    assert {r["corr"] for r in profile.correlation_matrix(df.limit(0)).collect()} <= {None}


def test_correlation_plan_does_not_grow_with_pairs(spark):
    wide = spark.range(50).select(*[(F.col("id") * k % 17).cast("double").alias(f"c{k}") for k in range(1, 41)])
    corr = profile.correlation_matrix(wide)
    assert corr.count() == 1600
    assert "corr(" not in corr._jdf.queryExecution().toString()


def exchanges(df):
    return re.findall(r"\bExchange\b", df._jdf.queryExecution().executedPlan().toString())


def test_customer_cell_rows_are_dealt_to_as_many_tasks_as_they_are_worth(spark, tables, monkeypatch):
    monkeypatch.setattr(aggregates, "tasks_for", lambda df: tasks_for(df, 100))
    stats = aggregates.customer_cell_stats(tables.transactions)
    assert len(exchanges(stats)) == 1
    assert stats.rdd.getNumPartitions() == -(-tables.transactions.count() // 100)


def test_withdraw_rate_joins_what_is_dealt_already(spark, tables, monkeypatch):
    monkeypatch.setattr(aggregates, "tasks_for", lambda df: 37)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = aggregates.withdraw_rate(tables.transactions, tables.withdrawals)._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    text = plan.toString()
    assert text.count("hashpartitioning(") == 2 and len(re.findall(r"\), 37\), REPARTITION_BY_NUM|, 37\), REPART", text)) == 2


def test_customer_summary_with_nulls(spark):
    tx = spark.createDataFrame(
        [(1, "a", 5, 2, 1.0), (1, "a", 5, 1, 2.0), (1, "b", 6, 1, 4.0), (1, None, None, 1, 1.0), (None, "a", 5, 3, 9.0)],
        "customer_id long, h3_09 string, mcc_code short, count short, sum double",
    )
    summary = aggregates.customer_summary(tx)
    assert "Expand" not in summary._jdf.queryExecution().executedPlan().toString()
    got = {r.customer_id: tuple(r)[1:] for r in summary.collect()}
    assert got == {1: (5, 8.0, 2, 2), None: (3, 9.0, 1, 1)}
