"""Row quality rules: a mapping of rule name to SQL predicate.

A row passes a rule when the predicate is true; false and NULL both fail.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rules = Mapping[str, str]

# The two ingestion rules.
TRIP_RULES: Rules = {
    "trip_miles_positive": "trip_miles > 0",
    "trip_time_positive": "trip_time > 0",
}


def keep_valid(df: DataFrame, rules: Rules = TRIP_RULES) -> DataFrame:
    """Rows passing every rule. The predicates stay plain, so they reach the Parquet scan."""
    return reduce(lambda rows, predicate: rows.filter(predicate), rules.values(), df)


def _fails(predicate: str) -> Column:
    return ~F.coalesce(F.expr(predicate), F.lit(False))


def failed_rules(rules: Rules) -> Column:
    """Array with the names of the failed rules, in rule order."""
    names = [F.when(_fails(p), F.lit(name)).otherwise("") for name, p in rules.items()]
    return F.array_remove(F.array(*names), "")


def tag(df: DataFrame, rules: Rules, column: str = "failed_rules") -> DataFrame:
    return df.withColumn(column, failed_rules(rules))


def rejected(df: DataFrame, rules: Rules, column: str = "failed_rules") -> DataFrame:
    """Rows failing at least one rule, with the reasons: the complement of ``keep_valid``."""
    return tag(df, rules, column).filter(F.size(column) > 0)


def metrics(df: DataFrame, rules: Rules) -> DataFrame:
    """(rule, failed_rows, total_rows, failure_rate), from one aggregate over the data."""
    counters = [F.count_if(_fails(p)).alias(f"failed_{i}") for i, p in enumerate(rules.values())]
    per_rule = [
        F.struct(
            F.lit(name).alias("rule"),
            F.col(f"failed_{i}").alias("failed_rows"),
            F.col("total_rows"),
            F.try_divide(F.col(f"failed_{i}").cast("double"), F.col("total_rows")).alias("failure_rate"),
        )
        for i, name in enumerate(rules)
    ]
    totals = df.agg(F.count(F.lit(1)).alias("total_rows"), *counters)
    return totals.select(F.inline(F.array(*per_rule)))


def alerts(df: DataFrame, rules: Rules, max_failure_rate: float) -> DataFrame:
    """Rules whose failure rate exceeds the limit."""
    return metrics(df, rules).filter(F.col("failure_rate") > F.lit(max_failure_rate))


def suite(layers: Mapping[str, DataFrame], rules: Rules) -> DataFrame:
    """The rule set run over each layer: one row per (layer, rule)."""
    checked = [
        metrics(df, rules).select(
            F.lit(layer).alias("layer"),
            "rule",
            "total_rows",
            "failed_rows",
            (F.col("failed_rows") == 0).alias("passed"),
        )
        for layer, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, checked)
