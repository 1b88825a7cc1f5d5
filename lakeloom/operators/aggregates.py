"""Grouped statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeloom.functions.numbers import pct
from lakeloom.session import cut_lineage


def with_share(grouped: DataFrame, value: str, name: str, digits: int = 1) -> DataFrame:
    """Share of the total over an aggregated frame.

    The total is a scalar subquery over the groups, so they never meet in one task as they
    would in an unpartitioned window.
    """
    total = grouped.agg(F.sum(value)).scalar()
    return grouped.withColumn(name, pct(F.col(value), total, digits))


BAND = 10_000  # values of a group that are put in order in one place
PROBES = 64


def exact_percentile(df: DataFrame, keys: list[str], value: str, p: float, name: str, band: int = BAND) -> DataFrame:
    """Exact interpolated percentile per group by distributed selection.

    For each of the two ranks that are interpolated, a bracket of values is narrowed: PROBES values from
    a sketch of the rows inside cut it, rows below each probe are counted exactly, and the piece that
    holds the rank is the next bracket. Each round leaves about 1 / PROBES of the rows, until no group
    has more than ``band`` rows inside or all of them are equal; only those are ordered. The sketch decides how fast a
    bracket shrinks, never the result. Nulls do not count; a null key is a group.
    """
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))

    def meet(bracket: DataFrame) -> DataFrame:
        """Rows inside the bracket of each target."""
        named = bracket.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_t", "_rank", "_lo", "_hi")
        on = F.lit(True)
        for i, k in enumerate(keys):
            on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
        met = rows.join(named if keys else F.broadcast(named), on)  # without keys there are two brackets
        return met.where((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))).drop(*[f"_k{i}" for i in range(len(keys))])

    whole = rows.groupBy(*keys).agg(F.count("_v").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    if not keys:
        whole = whole.where("_n > 0")
    pos = p * (F.col("_n") - 1)
    ranks = F.array(F.struct(F.lit(0).alias("_t"), F.floor(pos).alias("_rank")), F.struct(F.lit(1).alias("_t"), F.ceil(pos).alias("_rank")))
    whole = cut_lineage(whole.select(*keys, "_n", "_lo", "_hi", F.inline(ranks)))  # _rank: rows of the bracket before the wanted one
    open_ = (F.col("_n") > band) & (F.col("_lo") < F.col("_hi"))
    bracket = whole
    while not bracket.where(open_).isEmpty():
        target = [*keys, "_t"]
        inside = meet(bracket.where(open_))
        shares = F.array(*[F.lit(i / PROBES) for i in range(1, PROBES)])
        cuts = inside.groupBy(*target).agg(F.array_distinct(F.percentile_approx("_v", shares, 20 * PROBES)).alias("_cuts"))
        # a probe is a piece by itself, so that a frequent value does not hold a piece together
        piece = 2 * F.size(F.filter("_cuts", lambda c: c < F.col("_v"))) + F.array_contains("_cuts", F.col("_v")).cast("int")
        at = inside.alias("i").join(cuts.alias("c"), [F.col(f"i.{k}").eqNullSafe(F.col(f"c.{k}")) for k in target]).select("i.*", "_cuts")
        counted = at.groupBy(*target, "_rank", piece.alias("_piece")).agg(
            F.count("_v").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        before = F.sum("_n").over(W.partitionBy(*target).orderBy("_piece")) - F.col("_n")  # at most 2 * PROBES rows
        hit = counted.withColumn("_before", before).where("_before <= _rank and _rank < _before + _n")
        hit = hit.select(*keys, "_n", "_lo", "_hi", "_t", (F.col("_rank") - F.col("_before")).alias("_rank"))
        bracket = cut_lineage(bracket.where(~open_).unionByName(hit))
    single = bracket.where("_lo = _hi").select(*keys, "_t", F.col("_lo").alias("_x"))
    ordered = meet(bracket.where("_lo < _hi")).groupBy(*keys, "_t", "_rank").agg(F.sort_array(F.collect_list("_v")).alias("_all"))  # BAND values
    found = single.unionByName(ordered.select(*keys, "_t", F.get("_all", F.col("_rank").cast("int")).alias("_x")))
    ends = found.groupBy(*keys).agg(F.max(F.when(F.col("_t") == 0, F.col("_x"))).alias("_a"), F.max(F.when(F.col("_t") == 1, F.col("_x"))).alias("_b"))
    size = whole.where("_t = 0").select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], pos.alias("_pos"))
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    share = F.col("_pos") - F.floor("_pos")
    return ends.join(size if keys else F.broadcast(size), on).select(*keys, (F.col("_a") + share * (F.col("_b") - F.col("_a"))).alias(name))


def value_distribution(df: DataFrame, col: str) -> DataFrame:
    """Count and share of each value."""
    g = df.groupBy(F.col(col).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return with_share(g, "n", "share_pct", 2)


def histogram(df: DataFrame, keys: list[str], value: str, bins: list[int]) -> DataFrame:
    """Count per listed value, with a row for values that do not occur."""
    aggs = [F.count(F.when(F.col(value) == b, 1)).alias(f"_{b}") for b in bins]
    wide = df.groupBy(*keys).agg(*aggs)
    stack = ", ".join(f"{b}, _{b}" for b in bins)
    return wide.select(*keys, F.expr(f"stack({len(bins)}, {stack}) as ({value}, n)"))


def period_columns(df: DataFrame, keys: list[str], value: Column, periods: dict[str, Column]) -> DataFrame:
    """One sum column per named period, in a single pass."""
    aggs = [F.sum(F.when(cond, value).otherwise(F.lit(0))).cast("double").alias(name)
            for name, cond in periods.items()]
    return df.groupBy(*keys).agg(*aggs)


def change_pct(df: DataFrame, now: str, before: str, name: str = "change_pct", digits: int = 1) -> DataFrame:
    return df.withColumn(name, pct(F.col(now) - F.col(before), F.col(before), digits))


def contribution(df: DataFrame, dims: list[str], value: Column, before: Column, now: Column) -> DataFrame:
    """Which segment of each dimension explains the change between two periods.

    All dimensions are measured in one scan: every row is unpivoted to (dimension, segment).
    """
    pairs = ", ".join(f"'{d}', cast({d} as string)" for d in dims)
    long = df.where(before | now).select(
        F.when(now, value).otherwise(F.lit(0)).alias("_n"),
        F.when(before, value).otherwise(F.lit(0)).alias("_b"), *dims)
    long = long.select("_n", "_b", F.expr(f"stack({len(dims)}, {pairs}) as (dimension, segment)"))
    seg = long.groupBy("dimension", "segment").agg(
        F.sum("_b").cast("double").alias("before_value"), F.sum("_n").cast("double").alias("now_value"))
    seg = seg.withColumn("delta", F.round(F.col("now_value") - F.col("before_value"), 2))
    total = seg.where(F.col("dimension") == dims[0]).agg(F.sum(F.col("delta").cast("decimal(28,2)"))).scalar()
    return seg.withColumn("contribution_pct", pct(F.col("delta"), total, 2))
