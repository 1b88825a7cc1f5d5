"""Table maintenance written as DataFrame rewrites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fill_missing(df: DataFrame, col: str, value: Column, when: Column, stamp: str | None = None,
                 stamp_value: Column | None = None) -> DataFrame:
    """Fill ``col`` where it is NULL and ``when`` holds; other rows stay as they are."""
    cond = F.col(col).isNull() & when
    out = df.withColumn("_fill", cond).withColumn(col, F.when(F.col("_fill"), value).otherwise(F.col(col)))
    if stamp:
        old = F.col(stamp) if stamp in df.columns else F.lit(None).cast("timestamp_ntz")
        out = out.withColumn(stamp, F.when(F.col("_fill"), stamp_value).otherwise(old))
    return out.drop("_fill")


def delete_cascade(parent: DataFrame, doomed: Column, key: str, *children: DataFrame
                   ) -> tuple[DataFrame, list[DataFrame], list[DataFrame]]:
    """Delete parent rows and their children.

    Returns the remaining parent, the remaining children and the deleted rows of each child.
    """
    gone = parent.where(doomed).select(key)
    rest = parent.where(~F.coalesce(doomed, F.lit(False)))
    kept = [c.join(gone, key, "left_anti") for c in children]
    dropped = [c.join(gone, key, "left_semi") for c in children]
    return rest, kept, dropped


def stable_id(*cols: str) -> Column:
    """Row id that is the same in every run: digest of the key columns."""
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in cols]))


def apply_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Column defaults: fill NULLs, add columns that are absent."""
    for name, value in defaults.items():
        df = df.withColumn(name, F.coalesce(F.col(name), value) if name in df.columns else value)
    return df


def constraint_check(df: DataFrame, pk: list[str], not_null: list[str],
                     fks: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Violations of declared keys as rows (check_type, target, violations)."""
    nulls = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in not_null])
    stack = ", ".join(f"'{c}', {c}" for c in not_null)
    out = nulls.select(F.lit("not_null").alias("check_type"),
                       F.expr(f"stack({len(not_null)}, {stack}) as (target, violations)"))
    dup = df.groupBy(*pk).count().where("count > 1").agg(F.count(F.lit(1)).alias("violations"))
    out = out.unionByName(dup.select(F.lit("primary_key").alias("check_type"),
                                     F.lit(",".join(pk)).alias("target"), "violations"))
    for col, (parent, parent_key) in fks.items():
        orphans = df.where(F.col(col).isNotNull()).join(
            parent.select(F.col(parent_key).alias(col)), col, "left_anti")
        out = out.unionByName(orphans.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit("foreign_key").alias("check_type"), F.lit(col).alias("target"), "violations"))
    return out


def latest_changes(changes: DataFrame, key: str, seq: str) -> DataFrame:
    """Last change of each key; combines map-side, so a hot key costs one row per task."""
    rest = [c for c in changes.columns if c != key]
    last = changes.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("_last"))
    return last.select(key, "_last.*")


def apply_changes(base: DataFrame, changes: DataFrame, key: str, seq: str = "seq", op: str = "op") -> DataFrame:
    """Bring a full copy up to date with an ordered change log (I, U, D)."""
    last = latest_changes(changes, key, seq)
    live = last.where(F.col(op) != "D").select(*base.columns)
    return base.join(last.select(key), key, "left_anti").select(*base.columns).unionByName(live)
