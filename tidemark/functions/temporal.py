"""Calendar columns of a pickup time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pickup_month(pickup: str) -> Column:
    """Partition key ``yyyy-MM``."""
    return F.date_format(pickup, "yyyy-MM")


def calendar_features(pickup: str) -> dict[str, Column]:
    """Hour, weekday (1 = Sunday), month number and date of the pickup."""
    return {
        "pickup_hour": F.hour(pickup),
        "pickup_dayofweek": F.dayofweek(pickup),
        "pickup_month_num": F.month(pickup),
        "pickup_date": F.to_date(pickup),
    }


def event_time(pickup: str) -> Column:
    """The pickup as a zoned timestamp: watermarks are not allowed on ``timestamp_ntz``."""
    return F.col(pickup).cast("timestamp")
