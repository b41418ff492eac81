from __future__ import annotations

from datetime import datetime

from helpers import rows_of

from pyspark.sql import functions as F

from tidemark.operators.dedup import keep_first, keep_latest


def test_latest_copy_wins_and_ties_are_settled(spark):
    old, new = datetime(2024, 1, 1), datetime(2024, 1, 2)
    rows = [(1, old, "a"), (2, old, "b"), (2, new, "c"), (3, new, "z"), (3, new, "y"), (3, new, "y")]
    df = spark.createDataFrame(rows, "k int, seen timestamp, v string")
    assert rows_of(keep_latest(df, ["k"], "seen")) == [(1, old, "a"), (2, new, "c"), (3, new, "y")]


def test_each_task_sends_one_copy_of_a_hot_key(spark):
    """A key with most of the rows crosses the shuffle once per input task."""
    df = spark.range(0, 100_000, 1, 8).select(F.when(F.col("id") % 10 < 9, 0).otherwise(F.col("id")).alias("k"), "id")
    once = keep_first(df, ["k"], [F.asc("id")])
    once.collect()
    assert once.count() == df.select("k").distinct().count()
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_a_key_with_a_null_part_merges_only_equal_rows(spark):
    old, new = datetime(2024, 1, 1), datetime(2024, 1, 2)
    data = [(None, 1, old, "a"), (None, 1, new, "b"), (None, 1, new, "a"), (1, 1, old, "a"), (1, 1, new, "b")]
    df = spark.createDataFrame(data, "k long, m long, seen timestamp, v string")
    got = {(r.k, r.m, r.seen, r.v) for r in keep_latest(df, ["k", "m"], "seen").collect()}
    assert got == {(None, 1, new, "a"), (None, 1, new, "b"), (1, 1, new, "b")}
