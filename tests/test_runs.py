from __future__ import annotations

import json

import pytest
from helpers import rows_of

from pyspark.sql import functions as F

from tidemark.operators import runs

SCHEMA = "run_id long, processing_mode string, coalesce_n int, status string, seconds double"


@pytest.fixture
def trials(spark):
    return spark.createDataFrame(
        [
            (1, "loop", 8, "ok", 10.0),
            (2, "loop", 12, "ok", 10.0),
            (3, "loop", 16, "failed", 1.0),
            (4, "batch", 8, "ok", 30.0),
            (5, "none", 8, "failed", 5.0),
        ],
        SCHEMA,
    )


def test_best_run_is_successful_and_ties_go_to_the_first(trials):
    assert rows_of(runs.best_run_per_group(trials, "processing_mode")) == [("batch", 4, 30.0), ("loop", 1, 10.0)]


def test_success_rate(trials):
    assert rows_of(runs.success_rate(trials, "processing_mode")) == [
        ("batch", 1, 1, 1.0),
        ("loop", 3, 2, pytest.approx(2 / 3)),
        ("none", 1, 0, 0.0),
    ]


def test_marginals_take_one_factor_at_a_time(trials):
    got = runs.factor_marginals(trials, ["processing_mode", "coalesce_n"])
    assert {tuple(r)[:5] for r in got.collect()} == {
        ("batch", None, 1, 1, 30.0),
        ("loop", None, 1, 2, 10.0),
        (None, 8, 2, 2, 20.0),
        (None, 12, 2, 1, 10.0),
    }


def test_regressions_flag_the_outlier(spark):
    usual = [(i, "loop", 8, "ok", 4.0 + i / 10) for i in range(8)]
    slow = runs.run_regressions(spark.createDataFrame([*usual, (99, "loop", 8, "ok", 15.0)], SCHEMA), "processing_mode")
    assert [(r.run_id, r.seconds) for r in slow.collect()] == [(99, 15.0)]


def test_audit_record_leaves_out_absent_fields(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 01:02:03.456789' as at, cast(null as string) as file, 7 as id")
    fields = runs.audit_fields("at", F.lit("INFO"), F.lit('say "x"'), {"run_id": F.col("id"), "file_name": F.col("file")})
    record = json.loads(runs.audit_json(df, fields).first().record)
    assert record == {"timestamp": "2024-01-01T01:02:03.456Z", "level": "INFO", "message": 'say "x"', "run_id": 7}


def test_audit_record_says_where_it_was_made(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 01:02:03.456789' as at")
    origin = {"line": F.lit(7), "logger": F.lit("a.b"), "function": F.lit("f"), "module": F.lit(None).cast("string")}
    fields = runs.audit_fields("at", F.lit("INFO"), F.lit("m"), {"run_id": F.lit("r")}, origin)
    record = json.loads(runs.audit_json(df, fields).first().record)
    assert list(record) == ["timestamp", "level", "logger", "message", "function", "line", "run_id"]
    with pytest.raises(ValueError):
        runs.audit_fields("at", F.lit("INFO"), F.lit("m"), {}, {"thread": F.lit(1)})
