from __future__ import annotations

import math
from datetime import datetime

import pytest
from helpers import rows_of

from pyspark.sql import functions as F

from tidemark.operators import quality

NOON = datetime(2024, 1, 1, 12)
RULES = {**quality.TRIP_RULES, "trip_miles_is_number": "not isnan(trip_miles)"}


@pytest.fixture
def edge(trips):
    miles = [None, 0.0, -1.0, math.nan, 1.0]
    return trips(*[(i, NOON, m, 60) for i, m in enumerate(miles)], (5, NOON, 2.0, 0), (6, NOON, 2.0, None))


def test_ingestion_rules_are_strict_and_keep_nan(edge):
    assert [r.trip_id for r in quality.keep_valid(edge).orderBy("trip_id").collect()] == [3, 4]


def test_nan_is_a_rule_of_its_own(edge):
    assert [r.trip_id for r in quality.keep_valid(edge, RULES).collect()] == [4]


def test_tags_name_every_failed_rule_and_null_fails(edge):
    tagged = {r.trip_id: r.failed_rules for r in quality.tag(edge, RULES).collect()}
    assert tagged == {
        0: ["trip_miles_positive"],
        1: ["trip_miles_positive"],
        2: ["trip_miles_positive"],
        3: ["trip_miles_is_number"],
        4: [],
        5: ["trip_time_positive"],
        6: ["trip_time_positive"],
    }


def test_kept_and_rejected_are_complements(edge):
    kept = {r.trip_id for r in quality.keep_valid(edge, RULES).collect()}
    dropped = {r.trip_id for r in quality.rejected(edge, RULES).collect()}
    assert kept | dropped == set(range(7)) and not kept & dropped


def test_metrics_agree_with_the_exploded_tags(edge):
    counted = {r.rule: r.failed_rows for r in quality.metrics(edge, RULES).collect()}
    exploded = quality.tag(edge, RULES).select(F.explode("failed_rules").alias("rule")).groupBy("rule").count()
    assert counted == {r.rule: r["count"] for r in exploded.collect()}


def test_metrics_of_an_empty_frame(edge):
    none = quality.metrics(edge.filter("false"), RULES).collect()
    assert [(r.failed_rows, r.total_rows, r.failure_rate) for r in none] == [(0, 0, None)] * 3
    assert quality.alerts(edge.filter("false"), RULES, 0.0).collect() == []


def test_alerts_only_above_the_limit(edge):
    rules = [r.rule for r in quality.alerts(edge, RULES, 2 / 7).collect()]
    assert rules == ["trip_miles_positive"]


def test_suite_has_a_row_per_layer_and_rule(edge):
    checks = quality.suite({"raw": edge, "bronze": quality.keep_valid(edge)}, quality.TRIP_RULES)
    assert rows_of(checks.select("layer", "rule", "passed")) == [
        ("bronze", "trip_miles_positive", True),
        ("bronze", "trip_time_positive", True),
        ("raw", "trip_miles_positive", False),
        ("raw", "trip_time_positive", False),
    ]
