"""Date filters written as half-open ranges, so they reach the parquet scan as pushed filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(as_of: dt.date, offset: int = 0) -> dt.date:
    months = as_of.year * 12 + as_of.month - 1 + offset
    return dt.date(months // 12, months % 12 + 1, 1)


def between_dates(col: str | Column, start: dt.date, end: dt.date) -> Column:
    """start <= col < end."""
    c = F.col(col) if isinstance(col, str) else col
    return (c >= F.lit(start)) & (c < F.lit(end))


def in_month(col: str | Column, as_of: dt.date, offset: int = 0) -> Column:
    """Same calendar month as ``as_of`` shifted by ``offset`` months."""
    return between_dates(col, month_start(as_of, offset), month_start(as_of, offset + 1))


def in_year(col: str | Column, as_of: dt.date, offset: int = 0) -> Column:
    y = as_of.year + offset
    return between_dates(col, dt.date(y, 1, 1), dt.date(y + 1, 1, 1))


def in_month_or_year_ago(col: str | Column, as_of: dt.date) -> Column:
    """This month, or the same month of last year."""
    return in_month(col, as_of) | in_month(col, as_of, -12)


def wall_time(t: dt.date) -> Column:
    """Zone-less literal of a date or time; no zone of the driver or session takes part."""
    return F.lit(t.isoformat(" ") if isinstance(t, dt.datetime) else t.isoformat()).cast("timestamp_ntz")


def recent(col: str | Column, as_of: dt.datetime, **delta: float) -> Column:
    """col >= as_of - delta, e.g. ``recent("ts", now, minutes=5)``."""
    c = F.col(col) if isinstance(col, str) else col
    return c >= wall_time(as_of - dt.timedelta(**delta))


def month_of(col: str | Column) -> Column:
    return F.trunc(col, "month")


def grain_of(col: str | Column, grain: str) -> Column:
    """First day of the day, week, month or year of ``col``."""
    if grain == "day":
        return F.to_date(col)
    return F.trunc(col, grain)


def utc_instant(col: str) -> Column:
    """A zone-less time read as UTC, in any session zone. Watermarks need an instant."""
    return F.timestamp_micros(F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {col})"))


def utc_wall(col: str) -> Column:
    """Zone-less UTC time of an instant with whole seconds."""
    return F.expr(f"TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, unix_seconds({col}))")
