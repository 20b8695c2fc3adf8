"""Event time: which column holds it, and its UTC date.

Every expression here is independent of the session time zone: integers are
nanoseconds since the epoch and dates come from integer division.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NANOS_PER_DAY = 86_400 * 10**9
EVENT_TIME_COLUMNS = ("ts_event", "ts")
EPOCH = date(1970, 1, 1)


def event_time_column(df: DataFrame) -> str | None:
    """Name of the event-time column, or None if the table has none."""
    usable = (T.TimestampType, T.TimestampNTZType, T.IntegralType, T.DecimalType)
    for name in EVENT_TIME_COLUMNS:
        if name in df.columns:
            return name if isinstance(df.schema[name].dataType, usable) else None
    return None


def micros_to_nanos(ts: Column) -> Column:
    """Nanoseconds since the epoch of a timestamp without time zone."""
    micros = F.timestamp_diff("MICROSECOND", F.lit(EPOCH).cast("timestamp_ntz"), ts)
    return micros * F.lit(1000).cast("bigint")


def nanos_to_date(ns: Column) -> Column:
    """UTC date of integer nanoseconds; floors, so the last instant of a day stays."""
    day_ns = F.lit(NANOS_PER_DAY).cast("bigint")
    days = F.call_function("div", ns - F.pmod(ns, day_ns), day_ns)
    return F.date_from_unix_date(days.cast("int"))


def event_nanos(df: DataFrame) -> Column | None:
    """Event time as bigint nanoseconds whatever its stored type."""
    name = event_time_column(df)
    if name is None:
        return None
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        return micros_to_nanos(F.col(name))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name) * F.lit(1000).cast("bigint")
    return F.col(name).cast("bigint")


def event_date(df: DataFrame) -> Column | None:
    """UTC date of the event time, or None if the table has no event time."""
    name = event_time_column(df)
    if name is None:
        return None
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return F.to_date(name)
    return nanos_to_date(event_nanos(df))


def day_start_nanos(day: date) -> int:
    return (day - EPOCH).days * NANOS_PER_DAY


def window_predicate(
    df: DataFrame, start: date | None = None, end: date | None = None
) -> Column | None:
    """Predicate for an inclusive date window on the bare event-time column.

    The bounds are literals and the column is left untouched, so the predicate
    reaches the Parquet scan. A table without event time gets no predicate.
    """
    name = event_time_column(df)
    if name is None or (start is None and end is None):
        return None
    kind = df.schema[name].dataType
    ts = F.col(name)

    def bound(day: date) -> Column:
        if isinstance(kind, T.TimestampNTZType):
            return F.lit(day).cast("timestamp_ntz")
        nanos = day_start_nanos(day)
        if isinstance(kind, T.TimestampType):
            return F.timestamp_micros(F.lit(nanos // 1000))
        return F.lit(nanos).cast("bigint")

    keep = F.lit(True)
    if start is not None:
        keep = ts >= bound(start)
    if end is not None:
        before = ts < bound(date.fromordinal(end.toordinal() + 1))
        keep = before if start is None else keep & before
    return keep
