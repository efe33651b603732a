"""Typed values from request and calendar strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_weekday(date: Column) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(date) + 1


def calendar_date(value: Column) -> Column:
    """Date in the first ten characters."""
    return F.try_to_date(F.substring(value.cast("string"), 1, 10))


def flag(value: Column, default: bool) -> Column:
    """Boolean text, the default where it is missing or not readable."""
    return F.coalesce(value.try_cast("boolean"), F.lit(default))


def whole_number(value: Column, default: int) -> Column:
    return F.coalesce(value.try_cast("int"), F.lit(default))


def epoch_or_text(value: Column) -> Column:
    """Timestamp from epoch milliseconds, or from text that already is a date."""
    return F.coalesce(
        F.timestamp_millis(value.try_cast("bigint")), F.try_to_timestamp(value)
    )


def name_list(value: Column, default: str) -> Column:
    """Comma-separated names without spaces, ``[default]`` where NULL."""
    return F.when(value.isNull(), F.array(F.lit(default))).otherwise(
        F.split(F.replace(value, F.lit(" "), F.lit("")), ",", -1)
    )
