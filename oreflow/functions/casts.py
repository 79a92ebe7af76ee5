"""Casts that give null instead of failing the job on one bad value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: Column) -> Column:
    """ISO text or timestamp to date; malformed text becomes null."""
    return value.try_cast("date")


def as_int(value: Column) -> Column:
    """Truncating cast to a 32-bit integer; out of range becomes null."""
    return value.try_cast("int")


def whole(value: Column) -> Column:
    """Drop the fraction of a double, whatever its size."""
    return F.coalesce(value.try_cast("bigint").cast("double"), value)


def magnitude(value: Column) -> Column:
    """Absolute value as bigint. The one bigint without a counterpart becomes null."""
    number = value.try_cast("bigint")
    return F.when(number != F.lit(-(2**63)), F.abs(number))
