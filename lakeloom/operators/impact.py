"""Impact questions over job x table usage flags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.session import cut_lineage

FLAGS = {"create": "crud_c_flag", "read": "crud_r_flag", "update": "crud_u_flag", "delete": "crud_d_flag"}

# Words of a question and the tool that answers it.
TOOL_KEYWORDS = {
    "impact_analysis_tool": ["使用", "参照", "更新", "削除", "CREATE", "READ", "UPDATE", "DELETE", "CRUD",
                             "影響", "影響範囲", "どのジョブ", "どのプログラム", "棚卸し"],
    "source_code_search_tool": ["解説", "説明", "処理内容", "フロー", "どんな処理", "概要", "エラー", "障害", "原因",
                                "異常終了", "調査", "対処", "ソースコード", "ロジック", "アルゴリズム", "実装"],
}


def uses(*ops: str) -> Column:
    """Any of the given operations; all four when none is given."""
    return reduce(lambda a, b: a | b, [F.col(FLAGS[o]) == 1 for o in (ops or FLAGS)])


def jobs_of_table(crud: DataFrame, table: str, *ops: str) -> DataFrame:
    """Jobs that use a table; flags reach the scan as filters."""
    return crud.where((F.col("table_name_jp") == table) & uses(*ops)).select("ajs_name", "net_name", "src_name").distinct()


def tables_of_job(crud: DataFrame, job: str) -> DataFrame:
    return crud.where(F.col("ajs_name") == job).select("table_name_jp", *FLAGS.values())


def all_flags(crud: DataFrame, keys: list[str], *flags: str) -> DataFrame:
    """Keys that have every flag set in at least one of their rows."""
    g = crud.groupBy(*keys).agg(*[F.max(c).alias(c) for c in flags])
    return g.where(reduce(lambda a, b: a & b, [F.col(c) == 1 for c in flags])).select(*keys)


def crud_summary(crud: DataFrame) -> DataFrame:
    """Rows per operation (the declared counts) and distinct jobs per operation."""
    return crud.groupBy("table_name_jp").agg(
        *[F.sum(c).alias(f"{op}_rows") for op, c in FLAGS.items()],
        *[F.countDistinct(F.when(F.col(c) == 1, F.col("ajs_name"))).alias(f"{op}_jobs") for op, c in FLAGS.items()])


def impact_closure(crud: DataFrame, start: DataFrame, depth: int | None = None) -> DataFrame:
    """Tables reached from the start tables through jobs that read one table and write another.

    Breadth first over the table-level edges, one join a level, until no new table is reached; the
    lineage of each level is cut. With ``depth`` the search ends there, and ``is_complete`` tells
    whether that was all.
    """
    use = cut_lineage(crud.groupBy("table_name_jp", "ajs_name").agg(
        F.max("crud_r_flag").alias("r"), F.max(F.greatest("crud_c_flag", "crud_u_flag", "crud_d_flag")).alias("w")))
    reads = use.where("r = 1").select("table_name_jp", "ajs_name")
    writes = use.where("w = 1").select("ajs_name", F.col("table_name_jp").alias("target"))
    edges = cut_lineage(reads.join(writes, "ajs_name").select("table_name_jp", "target").distinct())
    seen = start.select("table_name_jp").distinct().withColumn("depth", F.lit(0))
    frontier, level, complete = seen, 0, False
    while not complete:
        level += 1
        nxt = edges.join(frontier, "table_name_jp", "left_semi").select(F.col("target").alias("table_name_jp")).distinct()
        frontier = cut_lineage(nxt.join(seen, "table_name_jp", "left_anti").withColumn("depth", F.lit(level)))
        complete = frontier.isEmpty()
        if level > (depth or level):
            break
        seen = seen.unionByName(frontier)
    return seen.withColumn("is_complete", F.lit(complete))


def route(questions: DataFrame, text: str, rules: dict[str, list[str]] | None = None) -> DataFrame:
    """Tools whose keywords occur in the question, and the kind of route; one pass, no join."""
    rules = rules or TOOL_KEYWORDS
    tools = [F.when(reduce(lambda a, b: a | b, [F.contains(F.col(text), F.lit(w)) for w in words]), F.lit(tool))
             for tool, words in rules.items()]
    hit = F.sort_array(F.array_compact(F.array(*tools)))
    return questions.withColumn("tools", hit).withColumn(
        "route", F.when(F.size("tools") == 0, "none").when(F.size("tools") == 1, F.get("tools", F.lit(0))).otherwise("both"))
