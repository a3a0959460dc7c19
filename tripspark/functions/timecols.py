"""Time expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

from tripspark.schemas import WEEKEND_DAY_NAMES, WEEKEND_DAY_NUMBERS


def as_timestamp(name: str, dtype: T.DataType) -> Column:
    """Timestamp from a column of any common source type.

    Strings go through ``try_to_timestamp`` so malformed text becomes null
    (ANSI mode would otherwise fail the job); ``timestamp_ntz`` is read as
    wall-clock time in the session zone.
    """
    c = F.col(name)
    if isinstance(dtype, T.TimestampType):
        return c
    if isinstance(dtype, T.StringType):
        return F.try_to_timestamp(c)
    return c.try_cast("timestamp")


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since the epoch; sub-seconds are floored."""
    return F.unix_seconds(ts)


def minutes_between(start: Column, end: Column) -> Column:
    """(whole seconds of end - whole seconds of start) / 60.0, as double."""
    return (epoch_seconds(end) - epoch_seconds(start)) / F.lit(60.0)


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def day_name(ts: Column) -> Column:
    """Short English day name: Mon .. Sun."""
    return F.date_format(ts, "E")


def year_month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def day_of_week(ts: Column) -> Column:
    """1 = Sunday .. 7 = Saturday."""
    return F.dayofweek(ts)


def weekend_from_day_name(dow: Column) -> Column:
    return F.when(dow.isin(*WEEKEND_DAY_NAMES), 1).otherwise(0)


def weekend_from_day_number(dow: Column) -> Column:
    return F.when(dow.isin(*WEEKEND_DAY_NUMBERS), 1).otherwise(0)
