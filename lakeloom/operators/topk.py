"""Ordered limits. The window form is pruned before its shuffle (WindowGroupLimit)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """First k rows in a total order; ``order`` must end in a unique key."""
    return df.orderBy(*order).limit(k)


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rn") -> DataFrame:
    """First k rows of each group with their position."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def numbered(df: DataFrame, order: list[Column], k: int, rank: str = "ref_no") -> DataFrame:
    """First k rows numbered 1..k. The numbering sees k rows only."""
    cut = top(df, order, k)
    return cut.withColumn(rank, F.row_number().over(W.orderBy(*order)))


def last_messages(conv: DataFrame, key: str, turn: str, n: int = 20) -> DataFrame:
    """Latest n messages of each conversation."""
    return top_per_group(conv, [key], [F.col(turn).desc()], n).drop("rn")


def history_arrays(conv: DataFrame, key: str, turn: str, fields: list[str], n: int = 20) -> DataFrame:
    """Latest n messages of each conversation as one array in turn order."""
    kept = last_messages(conv, key, turn, n)
    item = F.struct(turn, *fields)
    return kept.groupBy(key).agg(F.sort_array(F.collect_list(item)).alias("history"))
