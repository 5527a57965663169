"""Event-time column helpers.

Input times come as epoch milliseconds (``bigint``) or as TIMESTAMP_NTZ
columns.  Windows are computed with ``F.window`` directly on either type;
watermarks (``withWatermark``) need TIMESTAMP, so :func:`event_time` casts NTZ
through the session zone, which :func:`tidemark.session.pin_utc` fixes to UTC.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import pin_utc

_UNITS_US = {
    "us": 1, "microsecond": 1, "microseconds": 1,
    "ms": 1_000, "millisecond": 1_000, "milliseconds": 1_000,
    "s": 1_000_000, "sec": 1_000_000, "second": 1_000_000, "seconds": 1_000_000,
    "min": 60_000_000, "minute": 60_000_000, "minutes": 60_000_000,
    "h": 3_600_000_000, "hour": 3_600_000_000, "hours": 3_600_000_000,
    "d": 86_400_000_000, "day": 86_400_000_000, "days": 86_400_000_000,
}


def duration_us(d: str | int | dt.timedelta) -> int:
    """``"5 minutes"`` / ``timedelta`` / int milliseconds -> microseconds."""
    if isinstance(d, dt.timedelta):
        return (d.days * 86_400 + d.seconds) * 1_000_000 + d.microseconds
    if isinstance(d, int):
        return d * 1_000
    m = re.fullmatch(r"\s*(-?\d+)\s*([A-Za-z]+)\s*", d)
    if not m or m.group(2).lower() not in _UNITS_US:
        raise ValueError(f"cannot read duration {d!r}")
    return int(m.group(1)) * _UNITS_US[m.group(2).lower()]


def interval(d: str | int | dt.timedelta) -> Column:
    """A literal day-time interval usable in ``ts + interval(...)``."""
    return F.expr(f"INTERVAL '{duration_us(d)}' MICROSECOND")


def spark_duration(d: str | int | dt.timedelta) -> str:
    """Duration string accepted by ``F.window`` / ``withWatermark``."""
    return f"{duration_us(d)} microseconds"


def from_millis(col: str | Column) -> Column:
    """Epoch milliseconds -> TIMESTAMP."""
    return F.timestamp_millis(F.col(col) if isinstance(col, str) else col)


def event_time(df: DataFrame, col: str) -> Column:
    """The column as TIMESTAMP (what ``withWatermark`` accepts).

    TIMESTAMP_NTZ values are read as UTC wall-clock times.  The cast goes
    through the session zone, so the session is pinned to UTC here; in any
    other zone a daylight-saving gap or overlap would bend event-time
    arithmetic.
    """
    dtype = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dtype, T.TimestampType):
        return c
    if isinstance(dtype, T.TimestampNTZType):
        pin_utc(df.sparkSession)
        return c.cast("timestamp")
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return F.timestamp_millis(c)
    raise TypeError(f"{col}: no event time from {dtype.simpleString()}")


def epoch_us(df: DataFrame, col: str) -> Column:
    """Microseconds since the epoch of a time column (ordering, bucketing)."""
    return F.unix_micros(event_time(df, col))


def like_input(col: Column, df: DataFrame, name: str) -> Column:
    """Cast a TIMESTAMP result back to the type of input column ``name``."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampNTZType):
        pin_utc(df.sparkSession)
        return col.cast("timestamp_ntz")
    return col


def floor_div(a: Column, b: int | Column) -> Column:
    """Exact integer ``floor(a / b)`` for ``b > 0`` (no trip through double)."""
    bl = (b if isinstance(b, Column) else F.lit(b)).cast("long")
    a = a.cast("long")
    return F.call_function("div", a - F.pmod(a, bl), bl)


def window_bounds(ts: str | Column, size: str | int | dt.timedelta) -> tuple[Column, Column]:
    """Epoch-aligned, half-open tumbling window of ``ts``: (start, end)."""
    w = F.window(F.col(ts) if isinstance(ts, str) else ts, spark_duration(size))
    return w.getField("start"), w.getField("end")
