"""Answer sets compared as rows, so a large set is never built in one cell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.numbers import exact_avg


def union_all(first: DataFrame, *rest: DataFrame) -> DataFrame:
    for df in rest:
        first = first.unionByName(df)
    return first


def case_scores(expected: DataFrame, returned: DataFrame, case: str, item: str) -> DataFrame:
    """Per case: sizes, hits, recall, precision and exact match of two sets of (case, item) rows.

    An empty answer has precision 0. Cases that occur on one side only are kept.
    """
    e = expected.select(case, item).distinct().withColumn("_e", F.lit(1)).withColumn("_r", F.lit(0))
    r = returned.select(case, item).distinct().withColumn("_e", F.lit(0)).withColumn("_r", F.lit(1))
    pair = e.unionByName(r).groupBy(case, item).agg(F.max("_e").alias("_e"), F.max("_r").alias("_r"))
    g = pair.groupBy(case).agg(
        F.sum("_e").alias("n_expected"), F.sum("_r").alias("n_returned"),
        F.sum(F.col("_e") * F.col("_r")).alias("n_hit"))
    return g.withColumn(
        "recall", F.when(F.col("n_expected") > 0, F.col("n_hit") / F.col("n_expected"))
    ).withColumn(
        "precision", F.when(F.col("n_returned") > 0, F.col("n_hit") / F.col("n_returned")).otherwise(F.lit(0.0))
    ).withColumn(
        "exact_match", (F.col("n_hit") == F.col("n_expected")) & (F.col("n_hit") == F.col("n_returned")))


def macro_scores(cases: DataFrame) -> DataFrame:
    """Mean over cases (not pooled over items)."""
    return cases.agg(
        F.count(F.lit(1)).alias("cases"),
        F.round(exact_avg("recall", "decimal(20,10)"), 4).alias("mean_recall"),
        F.round(exact_avg("precision", "decimal(20,10)"), 4).alias("mean_precision"),
        F.round(exact_avg(F.col("exact_match").cast("int")), 4).alias("exact_match_rate"))


def result_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Bag difference of two results: rows only left, rows only right, equal flag."""
    cols = left.columns
    tagged = left.withColumn("_d", F.lit(1)).unionByName(right.select(*cols).withColumn("_d", F.lit(-1)))
    net = tagged.groupBy(*cols).agg(F.sum("_d").alias("_d"))
    return net.agg(
        F.coalesce(F.sum(F.when(F.col("_d") > 0, F.col("_d"))), F.lit(0)).alias("only_left"),
        F.coalesce(F.sum(F.when(F.col("_d") < 0, -F.col("_d"))), F.lit(0)).alias("only_right")
    ).withColumn("equal", (F.col("only_left") == 0) & (F.col("only_right") == 0))
