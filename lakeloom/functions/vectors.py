"""Vector columns (array<float>) with arithmetic in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def dot(a: str | Column, b: str | Column) -> Column:
    prod = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prod, F.lit(0.0), lambda s, x: s + x)


def norm(a: str | Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: str | Column, b: str | Column) -> Column:
    """Cosine similarity; NULL when a vector has zero length."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def normalized(a: str | Column) -> Column:
    """Unit vector in double, so that later scores are plain dot products."""
    n = norm(a)
    return F.transform(_c(a), lambda x: x.cast("double") / n)


def has_dim(a: str | Column, dim: int) -> Column:
    return F.coalesce(F.size(_c(a)) == dim, F.lit(False))
