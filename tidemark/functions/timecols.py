"""Time helpers: durations, interval literals, epoch conversions, as-of handling."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, functions as F

_UNITS = {
    "ms": 0.001, "millisecond": 0.001, "milliseconds": 0.001,
    "s": 1, "sec": 1, "second": 1, "seconds": 1,
    "m": 60, "min": 60, "minute": 60, "minutes": 60,
    "h": 3600, "hour": 3600, "hours": 3600,
    "d": 86400, "day": 86400, "days": 86400,
    "w": 604800, "week": 604800, "weeks": 604800,
}


def duration_seconds(value: str | int | float | dt.timedelta) -> float:
    """'30 seconds' / '1 minute' / '2 hours' / timedelta / number of seconds -> seconds."""
    if isinstance(value, dt.timedelta):
        return value.total_seconds()
    if isinstance(value, (int, float)):
        return float(value)
    m = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*([a-zA-Z]+)\s*", value)
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"unrecognised duration: {value!r}")
    return float(m.group(1)) * _UNITS[m.group(2).lower()]


def as_interval(value: str | int | float | dt.timedelta) -> Column:
    """A day-time interval literal usable in timestamp arithmetic."""
    return F.lit(dt.timedelta(seconds=duration_seconds(value)))


def _as_ltz(c: Column) -> Column:
    # unix_* functions need TIMESTAMP; NTZ values are wall-clock in the session zone.
    return c.cast("timestamp")


def epoch_millis(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_millis(_as_ltz(c))


def epoch_seconds_between(later: Column, earlier: Column) -> Column:
    """EXTRACT(EPOCH FROM later - earlier) as double seconds (microsecond precision)."""
    return (F.unix_micros(_as_ltz(later)) - F.unix_micros(_as_ltz(earlier))) / F.lit(1e6)


def utc_date(c: Column) -> Column:
    """The UTC date of a timestamp, whatever the session's time zone; the date of the stored
    wall clock for timestamp_ntz."""
    days = F.floor(F.unix_micros(_as_ltz(c)) / F.lit(86_400_000_000)).cast("int")
    return F.date_from_unix_date(days)


def time_bucket(col: Column | str, width: str | int | float | dt.timedelta) -> Column:
    """Epoch-aligned bucket number floor(epoch_us / width_us) (bigint)."""
    c = F.col(col) if isinstance(col, str) else col
    width_us = int(duration_seconds(width) * 1_000_000)
    return F.floor(F.unix_micros(_as_ltz(c)) / F.lit(width_us)).cast("bigint")


def resolve_as_of(as_of, reference: DataFrame | None = None, column: str | None = None) -> Column:
    """The query's notion of NOW().

    ``None`` -> ``current_timestamp()``; ``"max"`` -> the maximum of ``column`` in
    ``reference`` as a scalar subquery (deterministic replays and tests); a
    datetime or string -> literal; a Column is passed through.
    """
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str) and as_of == "max":
        if reference is None or column is None:
            raise ValueError("as_of='max' needs a reference DataFrame and column")
        return reference.select(F.max(column)).scalar()
    if isinstance(as_of, dt.datetime):
        return F.lit(as_of)
    return F.to_timestamp(F.lit(as_of))


def scan_bound(df: DataFrame, column: str, value: Column) -> Column:
    """``value`` as a scalar subquery of the type of ``column``. Compared with the column, Spark
    evaluates it before the scan and pushes the result into the file reader; it does not do so for
    an expression over a subquery, such as NOW() less an interval."""
    one = df.sparkSession.range(1)
    return one.select(value.cast(df.schema[column].dataType)).scalar()


def time_range_filter(df: DataFrame, col: str, lo: Column | None = None, hi: Column | None = None) -> DataFrame:
    """``lo <= col <= hi`` plus the implied bounds on the ``dt`` partition column.

    Tables written by :mod:`tidemark.operators.sinks` are partitioned by ``dt``, the UTC
    date of window_start, and alert tables also by ``detected_dt``, that of detected_at; a
    predicate on the timestamp alone does not prune them, so the date bounds are added.
    """
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(col) >= lo)
    if hi is not None:
        cond = cond & (F.col(col) <= hi)
    for part, source in (("dt", "window_start"), ("detected_dt", "detected_at")):
        if part in df.columns and col == source:
            if lo is not None:
                cond = cond & (F.col(part) >= utc_date(lo))
            if hi is not None:
                cond = cond & (F.col(part) <= utc_date(hi))
    return df.filter(cond)
