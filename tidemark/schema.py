"""Trip schemas, column naming, and conforming a frame to a declared schema."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class TripColumns:
    """Names of the columns the operators work on; every operator takes one of these."""

    trip_id: str = "trip_id"
    pickup: str = "pickup_datetime"
    miles: str = "trip_miles"
    seconds: str = "trip_time"
    location: str = "PULocationID"
    company: str = "hvfhs_license_num"
    fare: str = "base_passenger_fare"


TRIPS = TripColumns()


def struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Column names and types of the trip tables.
TRIP_SCHEMA = struct(
    trip_id=T.LongType(),
    pickup_datetime=T.TimestampNTZType(),
    trip_miles=T.DoubleType(),
    trip_time=T.IntegerType(),
    PULocationID=T.LongType(),
    hvfhs_license_num=T.StringType(),
    base_passenger_fare=T.DoubleType(),
)

RAW_TRIP_SCHEMA = T.StructType([*TRIP_SCHEMA.fields, T.StructField("source_file", T.StringType())])

BRONZE_SCHEMA = T.StructType(
    [
        *RAW_TRIP_SCHEMA.fields,
        T.StructField("pickup_date", T.DateType()),
        T.StructField("pickup_month", T.StringType()),
        T.StructField("ingestion_timestamp", T.TimestampType()),
    ]
)

SILVER_SCHEMA = T.StructType(
    [
        *BRONZE_SCHEMA.fields,
        T.StructField("pickup_hour", T.IntegerType()),
        T.StructField("pickup_dayofweek", T.IntegerType()),
        T.StructField("pickup_month_num", T.IntegerType()),
        T.StructField("speed_mph", T.DoubleType()),
    ]
)

SCHEMA_ISSUES = "column_name string, issue string, expected string, actual string, bad_values long"


def conform(df: DataFrame, target: T.StructType, keep_extra: bool = False) -> DataFrame:
    """Project ``df`` on the target schema: missing columns become NULL, other types are cast.

    A value the target type cannot hold becomes NULL; :func:`schema_issues` counts those.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    columns = [_conformed(f, present.get(f.name)) for f in target.fields]
    if keep_extra:
        columns += [F.col(name) for name in df.columns if name not in target.fieldNames()]
    return df.select(*columns)


def _conformed(field: T.StructField, actual: T.DataType | None) -> Column:
    if actual is None:
        return F.lit(None).cast(field.dataType).alias(field.name)
    if actual == field.dataType:
        return F.col(field.name)
    return cast_or_null(field.name, actual, field.dataType).alias(field.name)


def cast_or_null(name: str, actual: T.DataType, wanted: T.DataType) -> Column:
    """The value as another type, NULL where it does not fit.

    A cast that fails costs an exception per row. Text with letters is never an integer, so a
    column full of such text is recognised without trying.
    """
    value = F.col(name).try_cast(wanted)
    if isinstance(actual, T.StringType) and isinstance(wanted, T.IntegralType):
        return F.when(~F.col(name).rlike("[A-Za-z]"), value)
    return value


def union_all(frames: Sequence[DataFrame], target: T.StructType) -> DataFrame:
    """UNION ALL by column name of frames whose schemas may differ.

    Columns beyond the target are kept and NULL where a frame lacks them. Where their types differ
    they become bigint (integers only), double (numbers only) or text.
    """
    extras: dict[str, list[T.DataType]] = {}
    for df in frames:
        for field in df.schema.fields:
            if field.name not in target.fieldNames():
                extras.setdefault(field.name, []).append(field.dataType)
    retyped = {name: _common_type(kinds) for name, kinds in extras.items() if len(set(kinds)) > 1}
    conformed = [
        conform(df, target, keep_extra=True).withColumns(
            {name: F.col(name).cast(kind) for name, kind in retyped.items() if name in df.columns}
        )
        for df in frames
    ]
    result = conformed[0]
    for df in conformed[1:]:
        result = result.unionByName(df, allowMissingColumns=True)
    return result


def _common_type(kinds: Sequence[T.DataType]) -> T.DataType:
    if all(isinstance(kind, T.IntegralType) for kind in kinds):
        return T.LongType()
    if all(isinstance(kind, T.NumericType) for kind in kinds):
        return T.DoubleType()
    return T.StringType()


def schema_issues(df: DataFrame, target: T.StructType) -> DataFrame:
    """One row per missing, extra or differently typed column.

    For a differently typed column one aggregate over the data counts the values that
    ``conform`` would turn into NULL.
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    wanted = {f.name: f.dataType for f in target.fields}
    retyped = [n for n in wanted if n in actual and actual[n] != wanted[n]]

    def issue(name: str, kind: str, bad: Column) -> Column:
        expected = wanted[name].simpleString() if name in wanted else None
        found = actual[name].simpleString() if name in actual else None
        return F.struct(
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("issue"),
            F.lit(expected).cast("string").alias("expected"),
            F.lit(found).cast("string").alias("actual"),
            bad.cast("long").alias("bad_values"),
        )

    issues = [issue(n, "missing", F.lit(None)) for n in wanted if n not in actual]
    issues += [issue(n, "extra", F.lit(None)) for n in actual if n not in wanted]
    issues += [issue(n, "wrong_type", F.col(f"bad_{i}")) for i, n in enumerate(retyped)]
    if not issues:
        return df.sparkSession.createDataFrame([], SCHEMA_ISSUES)
    lost = [
        F.count_if(F.col(n).isNotNull() & cast_or_null(n, actual[n], wanted[n]).isNull()).alias(f"bad_{i}")
        for i, n in enumerate(retyped)
    ]
    return df.agg(F.count(F.lit(1)).alias("rows"), *lost).select(F.inline(F.array(*issues)))
