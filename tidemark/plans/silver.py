"""Bronze -> silver: clean, one row per trip, features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.measures import speed_mph, without_nan
from tidemark.functions.temporal import calendar_features
from tidemark.operators.dedup import keep_latest
from tidemark.operators.quality import TRIP_RULES, Rules, keep_valid
from tidemark.schema import TRIPS, TripColumns

TRIP_KEY = ("hvfhs_license_num", "trip_id", "pickup_datetime")


def clean(df: DataFrame, rules: Rules = TRIP_RULES, c: TripColumns = TRIPS) -> DataFrame:
    """Trim and upper-case the company key, turn NaN into NULL, drop rows failing the rules."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    cleaned = df.withColumns(
        {c.company: F.upper(F.trim(F.col(c.company))), **{name: without_nan(name) for name in floats}}
    )
    return keep_valid(cleaned, rules)


def dedup(df: DataFrame, keys: Sequence[str] = TRIP_KEY) -> DataFrame:
    """The most recently ingested copy of each trip."""
    return keep_latest(df, keys, "ingestion_timestamp")


def features(df: DataFrame, c: TripColumns = TRIPS) -> DataFrame:
    return df.withColumns({**calendar_features(c.pickup), "speed_mph": speed_mph(c.miles, c.seconds)})


def silver(df: DataFrame, keys: Sequence[str] = TRIP_KEY, rules: Rules = TRIP_RULES) -> DataFrame:
    return df.transform(clean, rules).transform(dedup, keys).transform(features)
