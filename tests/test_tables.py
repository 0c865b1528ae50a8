"""The tables derived from the line items."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from hexledger.session import tasks_for
from registry import bindings


def test_lines_are_shuffled_once_a_join_and_once_a_group(spark, tables):
    plan = tables._grouped_lines()._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bExchange\b", plan)) == 3  # lines, orders, groups
    assert "Sort" not in plan.replace("SortAggregate", "")


def test_tasks_grow_with_the_lines(spark, tables, monkeypatch):
    monkeypatch.setattr(bindings, "tasks_for", lambda df: tasks_for(df, 100))
    assert tables._grouped_lines().rdd.getNumPartitions() == -(-tables.raw("lineitem").count() // 100)


def test_withdrawals_are_the_pairs_of_small_returned_lines(spark, tables):
    orders = tables.raw("orders")
    lines = tables.raw("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    pairs = lines.filter("l_returnflag = 'R' AND l_quantity < 10").select(
        F.col("o_custkey").alias("customer_id"), bindings.cell_id("l_suppkey").alias("h3_09")
    )
    want = {tuple(r) for r in pairs.distinct().collect()}
    got = [tuple(r) for r in tables.withdrawals.collect()]
    assert set(got) == want and len(got) == len(want)
    assert "withdrawn" not in tables.transactions.columns
