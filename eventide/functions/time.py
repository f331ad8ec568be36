"""Event-time helpers.

Every operator works on a ``TimestampType`` event-time column.  Window bounds are
computed with exact integer arithmetic on epoch microseconds (no ``double``
division), so they are identical to Spark's ``window()`` and to SQL engines that
use epoch arithmetic, and they do not depend on the session time zone.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNITS = {
    "us": 1, "microsecond": 1, "microseconds": 1,
    "ms": 1_000, "millisecond": 1_000, "milliseconds": 1_000,
    "s": 1_000_000, "sec": 1_000_000, "second": 1_000_000, "seconds": 1_000_000,
    "min": 60_000_000, "minute": 60_000_000, "minutes": 60_000_000,
    "h": 3_600_000_000, "hour": 3_600_000_000, "hours": 3_600_000_000,
    "d": 86_400_000_000, "day": 86_400_000_000, "days": 86_400_000_000,
}

DAY_US = 86_400_000_000


def interval_micros(value) -> int:
    """Length of an interval in microseconds.

    Accepts ``"5 minutes"``, ``"1 hour"``, ``"10 seconds"``, a ``timedelta`` or an
    ``int`` (already microseconds).
    """
    if isinstance(value, bool):
        raise TypeError("interval must not be a bool")
    if isinstance(value, int):
        return value
    if isinstance(value, _dt.timedelta):
        return (value.days * 86_400 + value.seconds) * 1_000_000 + value.microseconds
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+)\s*", str(value))
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"cannot read interval {value!r}")
    return int(m.group(1)) * _UNITS[m.group(2).lower()]


def to_event_time(df: DataFrame, col: str, unit: str | None = None, out: str = "ts") -> DataFrame:
    """Add (or replace) ``out`` as a ``TimestampType`` instant taken from ``col``.

    * ``timestamp_ntz`` values are read as UTC wall-clock time (zone independent);
    * ``timestamp`` values are kept;
    * integral values need ``unit`` in ``{"s", "ms", "us"}`` (epoch based);
    * strings are parsed with ``to_timestamp``.
    """
    dtype = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dtype, T.TimestampNTZType):
        us = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{col}`)")
        ts = F.timestamp_micros(us)
    elif isinstance(dtype, T.TimestampType):
        ts = c
    elif isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType)):
        fn = {"s": F.timestamp_seconds, "ms": F.timestamp_millis, "us": F.timestamp_micros}
        if unit not in fn:
            raise ValueError("integral event time needs unit='s', 'ms' or 'us'")
        ts = fn[unit](c)
    elif isinstance(dtype, T.StringType):
        ts = F.to_timestamp(c)
    else:
        raise TypeError(f"unsupported event-time type {dtype}")
    return df.withColumn(out, ts)


def micros(ts: str | Column) -> Column:
    """Epoch microseconds of an event-time column."""
    return F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)


def millis(ts: str | Column) -> Column:
    """Epoch milliseconds (floored) of an event-time column."""
    return F.unix_millis(F.col(ts) if isinstance(ts, str) else ts)


def interval_millis(value) -> int:
    """Length of an interval in whole milliseconds (window sizes, slides, bounds)."""
    us = interval_micros(value)
    if us % 1000:
        raise ValueError(f"interval {value!r} is not a whole number of milliseconds")
    return us // 1000


def floor_to(v: Column, step: int, offset: int = 0) -> Column:
    """Largest ``offset + k*step`` not after ``v`` (exact integer floor, also below zero)."""
    return v - F.pmod(v - F.lit(offset), F.lit(step))


def window_end_ms(ts: str | Column, size, offset=0) -> Column:
    """End (exclusive, epoch ms) of the tumbling window of length ``size`` holding ``ts``."""
    size_ms, off_ms = interval_millis(size), interval_millis(offset)
    return floor_to(millis(ts), size_ms, off_ms) + F.lit(size_ms)


def window_start_ms(ts: str | Column, size, offset=0) -> Column:
    """Start (inclusive, epoch ms) of the tumbling window of length ``size`` holding ``ts``."""
    return floor_to(millis(ts), interval_millis(size), interval_millis(offset))


def next_utc_midnight(ts: str | Column) -> Column:
    """First UTC midnight strictly after the instant (the reference's daily reset time)."""
    return F.timestamp_millis(floor_to(millis(ts), DAY_US // 1000) + F.lit(DAY_US // 1000))
