from __future__ import annotations

import pytest
from helpers import rows_of

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema import conform, schema_issues, struct, union_all

TARGET = struct(a=T.IntegerType(), b=T.DoubleType())


def test_conform_casts_fills_and_drops(spark):
    df = spark.createDataFrame([("1", 5), ("x", 6)], "a string, c int")
    assert rows_of(conform(df, TARGET)) == [(1, None), (None, None)]
    assert conform(df, TARGET).schema == TARGET
    assert conform(df, TARGET, keep_extra=True).columns == ["a", "b", "c"]


@pytest.mark.parametrize("wanted", ["int", "bigint", "double", "date", "boolean"])
def test_text_is_cast_as_try_cast_does(spark, wanted):
    texts = ["7", " 7 ", "+7", "-7", "7.5", "1e3", "NaN", "0x1F", "1-URGENT", "x", "", " ", "9" * 30, "true", "2024-01-01", None]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    target = T.StructType([T.StructField("v", T._parse_datatype_string(wanted))])
    assert str(rows_of(conform(df, target))) == str(rows_of(df.select(F.col("v").try_cast(wanted))))


def test_union_of_drifting_frames_keeps_all_rows_and_columns(spark):
    first = spark.createDataFrame([(1, 1.5)], "a int, b double")
    second = spark.createDataFrame([(2, 2, 3)], "a int, b int, c int")
    assert rows_of(union_all([first, second], TARGET)) == [(1, 1.5, None), (2, 2.0, 3)]


def test_run_tables_of_two_versions_unite(spark):
    """A later version of a run table gained a column; earlier rows get NULL there."""
    old = spark.createDataFrame([(12, "ok", 75.05)], "coalesce_n int, status string, seconds double")
    new = spark.createDataFrame(
        [(8, "file_loop", "ok", 235.25)], "coalesce_n int, processing_mode string, status string, seconds double"
    )
    united = union_all([old, new], new.schema)
    assert rows_of(united) == [(12, None, "ok", 75.05), (8, "file_loop", "ok", 235.25)]
    assert [tuple(r) for r in schema_issues(old, new.schema).collect()] == [
        ("processing_mode", "missing", "string", None, None)
    ]


def test_schema_issues(spark):
    df = spark.createDataFrame([("1", 5), ("x", 6), (None, 7)], "a string, c int")
    assert rows_of(schema_issues(df, TARGET)) == [
        ("a", "wrong_type", "int", "string", 1),
        ("b", "missing", "double", None, None),
        ("c", "extra", None, "int", None),
    ]


def test_matching_schema_has_no_issues(spark):
    assert schema_issues(spark.createDataFrame([], TARGET), TARGET).collect() == []
