"""Inline rows without a Python data path: the rows become literals of the plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def values_relation(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """VALUES (...) AS t(columns)."""
    items = [F.struct(*[(v if hasattr(v, "alias") else F.lit(v)).alias(c) for c, v in zip(columns, r)])
             for r in rows]
    return spark.range(1).select(F.inline(F.array(*items)))
