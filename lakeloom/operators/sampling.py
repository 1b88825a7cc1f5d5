"""Stratified samples that are the same on every cluster, and estimates from them with error bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from lakeloom.operators.joins import small_rows
from lakeloom.operators.quality import Rule

MOST_STRATA = 10_000  # up to so many travel to the tasks, more are joined by an exchange
DIGITS = 12  # hexadecimal digits of a draw: 48 bits, exact in a double


def drawn(seed: int | str | Column, *cols: str | Column) -> Column:
    """Whole number from 0 to 2**48 - 1 that depends on the seed and the columns alone, not on partitions or order."""
    seed = seed if isinstance(seed, Column) else F.lit(str(seed))
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in cols]
    return F.conv(F.left(F.md5(F.concat_ws("|", seed.cast("string"), *parts)), F.lit(DIGITS)), 16, 10).cast("long")


def drawn_share(seed: int | Column, *cols: str | Column) -> Column:
    """Draw from 0 up to, but not including, 1."""
    return drawn(seed, *cols).cast("double") / float(16 ** DIGITS)


def shuffled_numbers(pool: DataFrame, key: str, name: str, total: int, per_slice: int = 1_000_000) -> DataFrame:
    """Numbers 0, 1, 2, ... without gaps, in the order of a draw on the key (no null), then of the key.

    Slices of the draw are numbered by themselves and continue each other, so that no task orders the whole pool;
    the numbers do not depend on the slices.
    """
    slices = max(1, -(-total // per_slice))
    x = pool.withColumn("_d", drawn("pool", key)).withColumn("_slice", F.floor(F.col("_d").cast("double") / float(16 ** DIGITS) * slices).cast("int"))
    before = F.coalesce(F.sum("_c").over(W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = x.groupBy("_slice").agg(F.count(F.lit(1)).alias("_c")).select("_slice", before.alias("_start"))  # a row a slice
    own = F.row_number().over(W.partitionBy("_slice").orderBy("_d", key))
    return x.withColumn("_own", own).join(starts, "_slice").withColumn(name, F.col("_start") + F.col("_own") - 1).drop("_d", "_slice", "_own", "_start")


def seeded_pick(rows: DataFrame, row_key: str, pool: DataFrame, pool_key: str, seed: int) -> DataFrame:
    """Join every row to one pool row drawn by seed and row key; no row is lost unless the pool is empty.

    The draw is one number per row, not per pair. Pool rows are numbered without gaps whatever their keys are.
    """
    n = pool.agg(F.count(F.lit(1))).first()[0]
    if not n:
        return rows.join(pool, F.lit(False))
    picks = rows.withColumn("_pick", F.pmod(drawn(seed, row_key), F.lit(n)))
    return picks.join(shuffled_numbers(pool, pool_key, "_pick", n), "_pick").drop("_pick")


def strata_sizes(df: DataFrame, strata: list[str]) -> DataFrame:
    return df.groupBy(*strata).agg(F.count(F.lit(1)).alias("stratum_rows"))


def _same(strata: list[str]) -> Column:
    same = F.lit(True)
    for c in strata:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return same


def _marked(df: DataFrame, strata: list[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"_{c}" for c in strata})


def stratified_sample(df: DataFrame, key: list[str], strata: list[str], per_stratum: int, seed: int | Column = 0) -> DataFrame:
    """About ``per_stratum`` rows of every stratum, small strata whole; adds ``stratum_rows``, the rows it was drawn from.

    Strata are combinations of the values, null included; their sizes come from one aggregation of these columns.
    Rows equal in ``key`` are drawn together. Which rows are drawn depends on key and seed alone.
    """
    sizes = _marked(strata_sizes(df, strata), strata)
    few = small_rows(sizes, MOST_STRATA)
    if few is not None:
        sizes = F.broadcast(df.sparkSession.createDataFrame(few, sizes.schema))
    x = df.join(sizes, _same(strata)).drop(*[f"_{c}" for c in strata])
    return x.where(drawn_share(seed, *key) < F.lit(float(per_stratum)) / F.col("stratum_rows"))


def estimated_failures(df: DataFrame, key: list[str], strata: list[str], rules: list[Rule], per_stratum: int = 2000,
                       seed: int | Column = 0, z: float = 1.96, by: list[str] = ()) -> DataFrame:
    """Share of rows that fail each rule, in percent, from a stratified sample, with its interval.

    Estimate: strata weighted by their rows. Variance: sum of (N_h / N)^2 (1 - n_h / N_h) p_h (1 - p_h) / (n_h - 1), so a
    stratum taken whole adds none. With ``z`` = 1.96 about 95 of 100 intervals hold the full value; shares
    within a few rows of 0 or 100 % do worse. The interval is null where a stratum has fewer than two rows in the sample
    and was not taken whole; a stratum without any is left out of the estimate. ``by`` are strata columns by which results are given.
    """
    s = stratified_sample(df, key, strata, per_stratum, seed)
    fails = [F.count(F.when(F.expr(r.predicate), None).otherwise(1)).alias(f"_{i}") for i, r in enumerate(rules)]
    seen = _marked(s.groupBy(*strata).agg(F.count(F.lit(1)).alias("_n"), *fails), strata)
    g = strata_sizes(df, strata).join(seen, _same(strata), "left").fillna(0, ["_n", *[f"_{i}" for i in range(len(rules))]])
    items = ", ".join(f"'{r.name}', _{i}" for i, r in enumerate(rules))
    g = g.select(*strata, F.col("stratum_rows").cast("double").alias("_N"), F.col("_n").cast("double").alias("_in"),
                 F.expr(f"stack({len(rules)}, {items}) as (rule, _k)"))
    p = F.when(F.col("_in") > 0, F.col("_k") / F.col("_in"))
    # nothing can be said of a stratum from a single row of it
    var = F.when(F.col("_in") == F.col("_N"), 0.0).when(F.col("_in") > 1, F.col("_N") * F.col("_N") * (1 - F.col("_in") / F.col("_N")) * p * (1 - p) / (F.col("_in") - 1))
    e = g.groupBy(*by, "rule").agg(F.sum(F.col("_N") * p).alias("_t"), F.sum(var).alias("_v"), F.count(F.when(var.isNull(), 1)).alias("_open"),
                                   F.sum(F.when(F.col("_in") > 0, F.col("_N"))).alias("_all"), F.sum("_in").cast("long").alias("sample_rows"))
    est = 100 * F.col("_t") / F.col("_all")
    half = F.when(F.col("_open") == 0, 100 * F.lit(z) * F.sqrt("_v") / F.col("_all"))
    return e.select(*by, "rule", "sample_rows", F.round(est, 3).alias("estimate_pct"),
                    F.when(half.isNotNull(), F.round(F.greatest(F.lit(0.0), est - half), 3)).alias("low_pct"),
                    F.when(half.isNotNull(), F.round(F.least(F.lit(100.0), est + half), 3)).alias("high_pct"))
