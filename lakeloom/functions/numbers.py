"""Aggregate helpers whose result does not depend on the order rows arrive in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def dbl(col: str | Column) -> Column:
    return _c(col).cast("double")


def sum_if(cond: Column, value: str | Column) -> Column:
    """Conditional sum with 0 for other rows: a group without a match gives 0."""
    return F.sum(F.when(cond, _c(value)).otherwise(F.lit(0)))


def count_if(cond: Column, value: str | Column | None = None) -> Column:
    """Conditional count; other rows are NULL and not counted."""
    return F.count(F.when(cond, F.lit(1) if value is None else _c(value)))


def avg_if(cond: Column, value: str | Column) -> Column:
    """Conditional mean; other rows are skipped, a group without a match gives NULL."""
    return exact_avg(F.when(cond, _c(value)))


def exact_avg(col: str | Column, decimal: str = "decimal(28,6)") -> Column:
    """Mean as exact decimal sum over count: the same for any partitioning of the rows."""
    c = _c(col)
    return F.sum(c.cast(decimal)).cast("double") / F.count(c)


def pct(n: Column, d: Column, digits: int = 1) -> Column:
    """100 * n / d, rounded; NULL for a zero denominator."""
    return F.round(n.cast("double") * 100.0 / F.nullif(d.cast("double"), F.lit(0.0)), digits)


def ratio(n: Column, d: Column, digits: int = 4) -> Column:
    return F.round(n.cast("double") / F.nullif(d.cast("double"), F.lit(0.0)), digits)
