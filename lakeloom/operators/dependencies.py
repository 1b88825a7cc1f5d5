"""Keys of tables and inclusions between their columns, found from the values themselves.

Every distinct value meets the names of all columns that hold it in one exchange, so the work does not grow with the
number of column pairs. The sets of names are counted; a column is included in another if all of its values lie in
sets that name both.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.session import cut_lineage

WHOLE = ("tinyint", "smallint", "int", "bigint")
PREFIX = "^[a-z]{1,2}_"  # a table's short prefix, no part of what a column means
NEAR = 0.8  # estimated share of distinct rows from which a pair is counted exactly
ERROR = 0.02  # standard error of that estimate


def comparable(df: DataFrame) -> list[str]:
    """Columns that can be keys: whole numbers and text."""
    return [c for c, t in df.dtypes if t in WHOLE or t == "string"]


def _value(df: DataFrame, c: str) -> Column:
    """Numbers as themselves, texts as a digest: one short string for both, which never meet."""
    return F.concat(F.lit("t"), F.md5(F.col(f"`{c}`"))) if dict(df.dtypes)[c] == "string" else F.col(f"`{c}`").cast("string")


def value_sets(tables: dict[str, DataFrame]) -> tuple[DataFrame, list[tuple[str, str]]]:
    """Rows (columns, n): sorted numbers of the columns that hold a value and the count of such values.

    The second result lists table and column by number. A value costs one row a task, however often it occurs.
    """
    names, parts = [], []
    for t, df in tables.items():
        cols = comparable(df)
        if not cols:
            continue
        pairs = [F.struct(F.lit(len(names) + i).alias("c"), _value(df, c).alias("v")) for i, c in enumerate(cols)]
        names += [(t, c) for c in cols]
        parts.append(df.select(F.explode(F.array(*pairs)).alias("x")).select("x.c", "x.v").where("v IS NOT NULL"))
    if not parts:
        raise ValueError("no table has a column of whole numbers or text")
    every = reduce(DataFrame.unionByName, parts)
    held = every.groupBy("v").agg(F.sort_array(F.collect_set("c")).alias("columns"))
    return held.groupBy("columns").agg(F.count(F.lit(1)).alias("n")), names


def column_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and values (not null) of every comparable column, one scan a table."""
    parts = []
    for t, df in tables.items():
        cols = comparable(df)
        if cols:
            items = ", ".join(f"'{c}', _{i}" for i, c in enumerate(cols))
            g = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(f"`{c}`").alias(f"_{i}") for i, c in enumerate(cols)])
            parts.append(g.select(F.lit(t).alias("table_name"), "n_rows", F.expr(f"stack({len(cols)}, {items}) as (column_name, n_present)")))
    return reduce(DataFrame.unionByName, parts)


def _columns(spark, names: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame([(i, t, c) for i, (t, c) in enumerate(names)], "c int, table_name string, column_name string")


class Dependencies:
    """Keys and inclusions of a set of tables; the value sets (a row for each set of columns that occurs) are kept.

    Null is no value: a column with nulls is no key, and inclusions look at the other rows. An empty table has
    neither keys nor inclusions. Texts are compared by their md5 digests, floating numbers and times not at all.
    """

    def __init__(self, tables: dict[str, DataFrame]):
        self.tables = tables
        sets, names = value_sets(tables)
        spark = sets.sparkSession
        self.sets = cut_lineage(sets)  # read by every question
        distinct = self.sets.select(F.explode("columns").alias("c"), "n").groupBy("c").agg(F.sum("n").alias("n_distinct"))
        self.columns = cut_lineage(_columns(spark, names).join(distinct, "c").join(column_counts(tables), ["table_name", "column_name"]))

    def single_keys(self) -> DataFrame:
        return self.columns.where("n_rows = n_present AND n_rows = n_distinct")

    def keys(self) -> DataFrame:
        """Rows (table_name, key_columns, n_rows): single columns, and pairs of whole numbers of which neither is a key."""
        one = self.single_keys().select("table_name", F.col("column_name").alias("key_columns"), "n_rows")
        alone = {(r[0], r[1]) for r in one.select("table_name", "key_columns").collect()}  # columns of the schemas
        out = one
        for t, df in self.tables.items():
            cols = [c for c, k in df.dtypes if k in WHOLE and (t, c) not in alone]
            for pair, n in unique_pairs(df, cols):
                out = out.unionByName(df.sparkSession.createDataFrame([(t, ",".join(pair), n)], "table_name string, key_columns string, n_rows bigint"))
        return out

    def inclusions(self) -> DataFrame:
        """Columns all of whose values occur in a key of another table.

        ``named`` tells whether both mean the same by name (``l_partkey`` and ``p_partkey``): small whole numbers
        lie in every longer key by chance, so that only named inclusions are taken as relationships.
        """
        child = self.columns.select(F.col("c").alias("child"), F.col("table_name").alias("child_table"), F.col("column_name").alias("child_column"),
                                    F.col("n_distinct").alias("n_values"))
        parent = self.single_keys().select(F.col("c").alias("parent"), F.col("table_name").alias("parent_table"),
                                           F.col("column_name").alias("parent_column"), F.col("n_distinct").alias("n_parent_values"))
        both = self.sets.select(F.explode("columns").alias("child"), "columns", "n").select("child", F.explode("columns").alias("parent"), "n")
        both = both.where("child <> parent").groupBy("child", "parent").agg(F.sum("n").alias("n_common"))
        met = both.join(child, "child").join(parent, "parent").where("n_common = n_values AND child_table <> parent_table")
        meaning = [F.regexp_replace(c, PREFIX, "") for c in ("child_column", "parent_column")]
        return met.select("child_table", "child_column", "parent_table", "parent_column", "n_values", "n_parent_values",
                          (meaning[0] == meaning[1]).alias("named"))


def unique_pairs(df: DataFrame, cols: list[str]) -> list[tuple[tuple[str, str], int]]:
    """Pairs of columns that tell all rows apart, with the number of rows.

    One scan estimates the distinct pairs; only pairs near the number of rows are grouped exactly. An estimate ten
    standard errors off would be needed to miss one.
    """
    pairs = list(combinations(cols, 2))
    if not pairs:
        return []
    g = df.agg(F.count(F.lit(1)).alias("n"), *[F.approx_count_distinct(F.xxhash64(*p), ERROR).alias(f"d{i}") for i, p in enumerate(pairs)],
               *[F.count(F.when(F.col(a).isNull() | F.col(b).isNull(), 1)).alias(f"m{i}") for i, (a, b) in enumerate(pairs)]).first()
    near = [p for i, p in enumerate(pairs) if g["n"] and not g[f"m{i}"] and g[f"d{i}"] >= NEAR * g["n"]]
    return [(p, g["n"]) for p in near if df.groupBy(*p).count().where("count > 1").isEmpty()]
