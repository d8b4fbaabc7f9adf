"""Microseconds and timestamps without the session's time zone: wall-clock times count as UTC, whatever the session is set to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY, HOUR = 86_400_000_000, 3_600_000_000


def micros(value: Column, kind: T.DataType) -> Column:
    """Microseconds since 1970 of a timestamp, or of a wall-clock time taken as UTC."""
    if isinstance(kind, T.TimestampNTZType):
        seconds = F.hour(value) * 3600 + F.minute(value) * 60
        fraction = (F.extract(F.lit("SECOND"), value) * 1_000_000).cast("long")
        return F.unix_date(value.cast("date")).cast("long") * DAY + seconds.cast("long") * 1_000_000 + fraction
    return F.unix_micros(value)


def floor_div(value: Column, by: int) -> Column:
    """Whole-number division that rounds down."""
    width = F.lit(by).cast("long")
    return F.call_function("div", value - F.pmod(value, width), width)


def wall_clock(micros_: Column) -> Column:
    """The UTC wall-clock time (without a zone) of microseconds since 1970."""
    seconds = (micros_.cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)


def cast(value: Column, a: T.DataType, b: T.DataType) -> Column:
    """Between timestamps with and without a zone, through UTC."""
    if isinstance(a, T.TimestampNTZType) and isinstance(b, T.TimestampType):
        return F.timestamp_micros(micros(value, a))
    if isinstance(a, T.TimestampType) and isinstance(b, T.TimestampNTZType):
        return wall_clock(F.unix_micros(value))
    return value.cast(b)
