"""Profiles, rules, scores and findings of a table, each from one scan."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.numbers import count_if, pct
from lakeloom.operators.textjobs import trailing_zscore


def profile(df: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """Rows, nulls, distinct values, min and max per column (min and max as text).

    ``exact=False`` counts distinct values with a sketch, which avoids the row expansion of
    several exact distinct counts.
    """
    distinct = F.countDistinct if exact else F.approx_count_distinct
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c in columns:
        aggs += [F.count(c).alias(f"{c}__n"), distinct(c).alias(f"{c}__d"),
                 F.min(c).cast("string").alias(f"{c}__lo"), F.max(c).cast("string").alias(f"{c}__hi")]
    items = ", ".join(f"'{c}', _rows, _rows - {c}__n, {c}__d, {c}__lo, {c}__hi" for c in columns)
    return df.agg(*aggs).select(F.expr(
        f"stack({len(columns)}, {items}) as (column_name, n_rows, n_null, n_distinct, min_value, max_value)"))


def exact_distinct(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values (not null) per column; equal values of a column fold before the exchange."""
    each = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("_v")) for c in columns])
    values = df.select(F.explode(each).alias("x")).select("x.*").groupBy("column_name", "_v").agg(F.lit(1))
    return values.groupBy("column_name").agg(F.count("_v").alias("n_exact"))


def null_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    items = ", ".join(f"'{c}', _rows - {c}, _rows" for c in columns)
    g = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in columns])
    return g.select(F.expr(f"stack({len(columns)}, {items}) as (column_name, n_null, n_rows)")).withColumn(
        "null_pct", pct(F.col("n_null"), F.col("n_rows"), 2)).orderBy(F.col("n_null").desc(), "column_name")


@dataclass(frozen=True)
class Rule:
    """A predicate every row should meet; NULL counts as a failure."""

    name: str
    predicate: str
    weight: float = 1.0


def check_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Pass and fail counts of all rules in one scan."""
    g = df.agg(F.count(F.lit(1)).alias("_rows"), *[count_if(F.expr(r.predicate)).alias(f"_{i}") for i, r in enumerate(rules)])
    items = ", ".join(f"'{r.name}', _{i}, _rows - _{i}, {r.weight}D" for i, r in enumerate(rules))
    return g.select(F.expr(f"stack({len(rules)}, {items}) as (rule, passed, failed, weight)")).withColumn(
        "fail_pct", pct(F.col("failed"), F.col("passed") + F.col("failed"), 2)).withColumn("status", F.when(F.col("failed") == 0, "pass").otherwise("fail"))


def score(rule_results: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Data-quality score: 100 less the weighted mean of the failure percentages, not below 0.

    The formula is this library's choice: score = 100 - sum(weight * fail_pct) / sum(weight).
    """
    loss = F.sum((F.col("weight") * F.col("fail_pct")).cast("decimal(18,6)")).cast("double") / F.sum("weight")
    return rule_results.groupBy(*keys).agg(F.round(F.greatest(F.lit(0.0), 100.0 - loss), 2).alias("score"))


def run_metrics(df: DataFrame, day: str, value: str, null_of: str) -> DataFrame:
    """Metrics of each daily run: rows, share of NULLs, mean; unpivoted to (metric, day, value)."""
    g = df.groupBy(F.to_date(day).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count(null_of).alias("k"), F.sum(F.col(value).cast("decimal(18,2)")).alias("s"))
    return g.select("day", F.expr(
        "stack(3, 'row_count', cast(n as decimal(18,4)), 'null_pct', cast((n - k) * 100 / n as decimal(18,4)), "
        "'mean_value', cast(cast(s as double) / n as decimal(18,4))) as (metric, value)"))


def metric_anomalies(metrics: DataFrame, width: int = 7, limit: float = 2.0) -> DataFrame:
    """Runs outside the bounds learned from the runs before: mean +- limit deviations."""
    return trailing_zscore(metrics, ["metric"], "day", "value", width, limit)


def cross_column(df: DataFrame, left: str, right: str, tolerance: str = "0.01") -> DataFrame:
    """Rows that break left = right."""
    return df.where(F.abs(F.expr(left) - F.expr(right)) > F.expr(tolerance))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    return child.where(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def hash_sample(df: DataFrame, key: str, percent: int) -> DataFrame:
    """Rows whose key falls into the first ``percent`` of 100 hash slots: stable over runs and joins."""
    return df.where(F.pmod(F.xxhash64(key), F.lit(100)) < percent)


def day_slice(df: DataFrame, ts: str, day: dt.date) -> DataFrame:
    """Rows of one day, as a range the scan can push down."""
    from lakeloom.functions.dates import between_dates
    return df.where(between_dates(ts, day, day + dt.timedelta(days=1)))
