"""What the operators of this subpackage share: whole texts, words as columns, staged tables, the registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

WORD_GAP = r"[\x20\x09-\x0D]+"
LEAST_LONG = -(1 << 63)


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame``; ``sql`` is its DuckDB twin (None: tested by brute force)."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and whole text; a null text counts as empty. Other columns are not read."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def order_key(col: str = "doc_id") -> Column:
    """Sort key in which a null id comes first."""
    return F.coalesce(F.col(col).cast("long"), F.lit(LEAST_LONG))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once for a body that uses it many times, inside lambdas too."""
    return F.transform(F.array(value), body)[0]


def words(col: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the whole text."""
    return F.filter(F.split(col, WORD_GAP), lambda w: w != "")


def staged(df: DataFrame, purpose: str, path: str | None = None, **options) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives a lost executor. ``options`` are the writer's."""
    path = path or shared_dir(df.sparkSession, purpose)
    df.write.options(compression="zstd", **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
