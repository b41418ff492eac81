"""Derived measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_HOUR = 3600


def speed_mph(miles: str, seconds: str) -> Column:
    """Miles per hour; NULL when the duration is zero or NULL."""
    return F.try_divide(F.col(miles), F.col(seconds) / F.lit(SECONDS_PER_HOUR))


def without_nan(name: str) -> Column:
    return F.when(~F.isnan(name), F.col(name))


def hash_fraction(key: str) -> Column:
    """A number in [0, 1) that depends on the key value only (leading 32 bits of its MD5); NULL counts as ''."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    head = F.substring(F.md5(text.cast("binary")), 1, 8)
    return F.conv(head, 16, 10).cast("double") / F.lit(float(2**32))
