"""Date expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType

# The range of integer dates that the quality rule accepts.
INT_DATE_MIN = 19000101
INT_DATE_MAX = 20500101


def parse_int_date(value: Column) -> Column:
    """``yyyymmdd`` held in an int; null unless it is a real eight-digit date."""
    digits = value.cast("string")
    # Written out with dashes it is parsed without a formatter, in half the time.
    dashed = F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 2), F.substring(digits, 7, 2))
    return F.when(F.length(digits) == 8, dashed.try_cast("date"))


def is_bad_int_date(value: Column) -> Column:
    return (
        (value <= 0)
        | (F.length(value.cast("string")) != 8)
        | (value > INT_DATE_MAX)
        | (value < INT_DATE_MIN)
    )


def instant(value: dt.datetime, kind: DataType) -> Column:
    """Literal for comparison with a column of type ``kind``.

    A timestamp without time zone is compared by its wall-clock reading, so it
    must not pass through the session's time zone.
    """
    if isinstance(kind, TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast(kind)
    return F.lit(value)


def past_or_null(value: Column, today: dt.date) -> Column:
    return F.when(value <= F.lit(today), value)


def day_before(value: Column) -> Column:
    return F.date_sub(value, 1)


def whole_seconds(start: Column, end: Column) -> Column:
    """Elapsed seconds between two timestamps, to the nearest second."""
    return F.round(F.unix_micros(end) / 1e6 - F.unix_micros(start) / 1e6).cast("int")
