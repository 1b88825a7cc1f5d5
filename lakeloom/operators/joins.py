"""Joins. Broadcasting is left to Spark's own size check (autoBroadcastJoinThreshold, AQE)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM_SIZES = (2, 4, 8, 16)
MAX_INLINE_ROWS = 10_000  # rows that may be turned into a literal of the plan


def lookup(fact: DataFrame, dim: DataFrame, keys: str | list[str], how: str = "left") -> DataFrame:
    """N:1 join of a fact to a dimension."""
    return fact.join(dim, keys, how)


def small_rows(df: DataFrame, cap: int = MAX_INLINE_ROWS) -> list | None:
    """Rows of a frame if it has at most ``cap`` of them, else None. Reads cap + 1 rows at most."""
    rows = df.take(cap + 1)
    return rows if len(rows) <= cap else None


def cross_grid(base: DataFrame, *axes: dict[str, DataFrame | list]) -> DataFrame:
    """Every combination of base rows and axis values.

    A short axis is attached as an exploded array literal (no join at all); a longer one, which
    makes the grid itself large, goes through Spark's cartesian product.
    """
    out = base
    for axis in axes:
        for name, values in axis.items():
            if isinstance(values, list):
                out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
                continue
            rows = small_rows(values)
            if rows is None:
                out = out.crossJoin(values.toDF(name))
            elif rows:
                out = out.withColumn(name, F.explode(F.array(*[F.lit(r[0]) for r in rows])))
            else:
                out = out.withColumn(name, F.lit(None).cast(values.dtypes[0][1])).limit(0)
    return out


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: number of keys that occur more than once."""
    return df.groupBy(*keys).count().where("count > 1").agg(F.count(F.lit(1)).alias("repeated"))


def fanout_check(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Tell the cardinality of a declared relationship before it is used in a join."""
    l_rep = repeated_keys(left, keys).select(F.lit("left").alias("side"), "repeated")
    r_rep = repeated_keys(right, keys).select(F.lit("right").alias("side"), "repeated")
    both = l_rep.unionByName(r_rep).agg(
        F.max(F.when(F.col("side") == "left", F.col("repeated"))).alias("left_repeated_keys"),
        F.max(F.when(F.col("side") == "right", F.col("repeated"))).alias("right_repeated_keys"))
    l_many, r_many = F.col("left_repeated_keys") > 0, F.col("right_repeated_keys") > 0
    return both.withColumn("cardinality", F.when(l_many & r_many, "N:M").when(l_many, "N:1")
                           .when(r_many, "1:N").otherwise("1:1")) \
               .withColumn("safe", ~(l_many & r_many))


def guarded_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join that refuses an N:M relationship; pre-aggregate one side first."""
    if not fanout_check(left, right, keys).first()["safe"]:
        raise ValueError(f"keys {keys} repeat on both sides: the join would multiply rows")
    return left.join(right, keys, how)


def not_in(src: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """``key NOT IN (SELECT key FROM target)`` with SQL null rules, as a shuffled anti join.

    A null-aware anti join needs a broadcast build side; two scalar counts give the same rows
    for a target of any size.
    """
    counts = target.agg(F.count(F.lit(1)).alias("n"), F.count(key).alias("k"))
    n_all = counts.select("n").scalar()
    n_null = counts.select(F.col("n") - F.col("k")).scalar()
    kept = src.join(target.select(key), key, "left_anti")
    return kept.where((n_all == 0) | ((n_null == 0) & F.col(key).isNotNull()))


def insert_missing(src: DataFrame, target: DataFrame, keys: str | list[str]) -> DataFrame:
    """Rows of ``src`` whose key is absent from ``target`` (NOT EXISTS)."""
    return src.join(target, keys, "left_anti")


def grams(text: str, q: int) -> Column:
    """Distinct substrings of q characters."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - (q - 1), F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(F.col(text), i, F.lit(q))))


def contains_join(texts: DataFrame, text_col: str, patterns: DataFrame, pattern_col: str,
                  max_inline: int = 500) -> DataFrame:
    """Pairs where the text contains the pattern: ``text LIKE '%' || pattern || '%'``.

    Few distinct patterns (checked) are tested in one pass over the texts, and the hits are joined
    back to the pattern rows. Otherwise texts and patterns meet on a shared n-gram, an equi join of
    (text number, gram) rows; only the distinct meetings fetch their text and are verified. A pattern
    may occur in any number of rows; the empty pattern is in every text that is not NULL.
    """
    pats = patterns.where(F.col(pattern_col).isNotNull())  # the empty pattern is in every text
    rows = small_rows(pats.select(pattern_col).distinct(), max_inline)
    if rows is not None:
        if not rows:
            return texts.join(pats, F.lit(False))
        lit = F.array(*[F.lit(r[0]) for r in rows])
        hits = texts.withColumn("_hit", F.explode(
            F.filter(lit, lambda p: F.contains(F.col(text_col), p))))
        return hits.join(pats, F.col("_hit") == F.col(pattern_col)).drop("_hit")
    # patterns meet the texts by length class, so that a short pattern does not shorten all grams
    # (a gram row carries the text's hash, not the text)
    n = F.length(pattern_col)
    size = F.when(n >= 1, F.lit(1)).otherwise(F.lit(0))
    for q in GRAM_SIZES:
        size = F.when(n >= q, F.lit(q)).otherwise(size)
    sized = pats.withColumn("_size", size)
    out = None
    digest = F.sha2(text_col, 256)  # equal digests are taken as equal texts, so that no text is a key of an exchange
    bodies = texts.where(F.col(text_col).isNotNull()).select(digest.alias("_t"), F.col(text_col).alias("_body")).dropDuplicates(["_t"])
    for q in sorted(r[0] for r in sized.select("_size").distinct().collect()):  # at most six values
        own = sized.where(F.col("_size") == q).select(F.col(pattern_col).alias("_pattern")).distinct()
        if q == 0:
            met = bodies.crossJoin(F.broadcast(own))  # the empty pattern alone
        else:
            left = bodies.select("_t", F.explode(grams("_body", q)).alias("_gram"))
            met = left.join(own.withColumn("_gram", F.left("_pattern", F.lit(q))), "_gram").select("_t", "_pattern").distinct() \
                .join(bodies, "_t").where(F.contains("_body", F.col("_pattern")))
        hits = texts.withColumn("_t", digest).join(met.select("_t", "_pattern"), "_t") \
            .join(pats, F.col("_pattern") == F.col(pattern_col)).drop("_t", "_pattern")
        out = hits if out is None else out.unionByName(hits)
    return out
