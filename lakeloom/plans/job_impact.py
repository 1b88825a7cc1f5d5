"""Impact analysis over the job x table frame and question routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions.text import tokens
from lakeloom.operators import impact, keyword, similarity
from lakeloom.plans.registry import query
from lakeloom.plans.search import WORDS, bm25_sql, ranked_sql

ANY = "(crud_c_flag = 1 OR crud_r_flag = 1 OR crud_u_flag = 1 OR crud_d_flag = 1)"


@query("jobs_using_table", f"SELECT DISTINCT ajs_name, net_name, src_name FROM crud WHERE table_name_jp = 'T_7' AND {ANY}", "crud")
def _using(f):
    return impact.jobs_of_table(f.crud(), "T_7")


@query("jobs_by_crud_flag", " UNION ALL ".join(
    f"SELECT DISTINCT '{op}' AS operation, ajs_name, net_name, src_name FROM crud WHERE table_name_jp = 'T_7' AND {c} = 1"
    for op, c in impact.FLAGS.items()), "crud")
def _by_flag(f):
    # one pass: the set flags of a row are listed, then exploded
    ops = F.array_compact(F.array(*[F.when(F.col(c) == 1, F.lit(op)) for op, c in impact.FLAGS.items()]))
    return f.crud().where("table_name_jp = 'T_7'").select(
        F.explode(ops).alias("operation"), "ajs_name", "net_name", "src_name").distinct()


@query("tables_by_job", "SELECT table_name_jp, crud_c_flag, crud_r_flag, crud_u_flag, crud_d_flag FROM crud WHERE ajs_name = 'JOB_0000000008'", "crud")
def _tables(f):
    return impact.tables_of_job(f.crud(), "JOB_0000000008")


@query("jobs_in_net", "SELECT DISTINCT ajs_name FROM crud WHERE net_name = 'NET_3'", "crud")
def _net(f):
    return f.crud().where("net_name = 'NET_3'").select("ajs_name").distinct()


@query("file_output", "SELECT DISTINCT function_name, module_name, ajs_name FROM crud WHERE file_o_flg = 1", "crud")
def _out(f):
    return f.crud().where("file_o_flg = 1").select("function_name", "module_name", "ajs_name").distinct()


@query("file_input", "SELECT DISTINCT ajs_name, net_name FROM crud WHERE file_i_flg = 1", "crud")
def _in(f):
    return f.crud().where("file_i_flg = 1").select("ajs_name", "net_name").distinct()


@query("functions_in_module", "SELECT function_name, count(DISTINCT ajs_name) AS job_count FROM crud WHERE module_name = 'MOD_2' GROUP BY 1", "crud")
def _functions(f):
    return f.crud().where("module_name = 'MOD_2'").groupBy("function_name").agg(F.countDistinct("ajs_name").alias("job_count"))


@query("crud_summary", "SELECT table_name_jp, " + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {op}_rows" for op, c in impact.FLAGS.items()) + ", "
       + ", ".join(f"count(DISTINCT CASE WHEN {c} = 1 THEN ajs_name END) AS {op}_jobs" for op, c in impact.FLAGS.items())
       + " FROM crud GROUP BY 1", "crud")
def _summary(f):
    return impact.crud_summary(f.crud())


@query("crud_and", """SELECT 'job' AS level, src_name FROM crud GROUP BY src_name HAVING max(crud_u_flag) = 1 AND max(crud_d_flag) = 1
UNION ALL SELECT 'row', src_name FROM (SELECT DISTINCT src_name FROM crud WHERE crud_u_flag = 1 AND crud_d_flag = 1)""", "crud")
def _and(f):
    c = f.crud()
    job = impact.all_flags(c, ["src_name"], "crud_u_flag", "crud_d_flag").select(F.lit("job").alias("level"), "src_name")
    row = c.where("crud_u_flag = 1 AND crud_d_flag = 1").select(F.lit("row").alias("level"), "src_name").distinct()
    return job.unionByName(row)


@query("module_table_readers", "SELECT DISTINCT function_name, ajs_name FROM crud WHERE module_name = 'MOD_0' AND table_name_jp = 'T_7' AND crud_r_flag = 1", "crud")
def _readers(f):
    return f.crud().where("module_name = 'MOD_0' AND table_name_jp = 'T_7' AND crud_r_flag = 1").select("function_name", "ajs_name").distinct()


@query("file_in_and_out", "SELECT function_name, ajs_name FROM crud GROUP BY 1, 2 HAVING max(file_i_flg) = 1 AND max(file_o_flg) = 1", "crud")
def _in_out(f):
    return impact.all_flags(f.crud(), ["function_name", "ajs_name"], "file_i_flg", "file_o_flg")


@query("jobs_with_net", "SELECT DISTINCT ajs_name, net_name FROM crud WHERE table_name_jp = 'T_11'", "crud")
def _with_net(f):
    return f.crud().where("table_name_jp = 'T_11'").select("ajs_name", "net_name").distinct()


@query("jobs_by_source", "SELECT DISTINCT ajs_name, net_name FROM crud WHERE src_name = 'JOB_0000000012.sql'", "crud")
def _by_source(f):
    return f.crud().where("src_name = 'JOB_0000000012.sql'").select("ajs_name", "net_name").distinct()


@query("impact_to_search", "WITH " + bm25_sql(
    "SELECT s.source_id, s.source_code FROM src s SEMI JOIN (SELECT ajs_name FROM crud WHERE table_name_jp = 'T_7' AND crud_u_flag = 1) j USING (ajs_name)",
    "source_id", "source_code", "SELECT item_id, text FROM benchmark", "item_id", "text")
    + f" SELECT query_id, doc_id, score, rn FROM {ranked_sql('bm', 2)}", "crud src")
def _impact_search(f):
    """Sources of the jobs that update a table, searched with every stored question."""
    jobs = impact.jobs_of_table(f.crud(), "T_7", "update").select("ajs_name")
    src = f.src().join(jobs, "ajs_name", "left_semi")
    return keyword.bm25_topk(src, "source_id", "source_code", f.benchmark, "item_id", "text", 2)


@query("crud_catalog_counts", """SELECT count(*) AS records, count(DISTINCT ajs_name) AS jobs, count(DISTINCT table_name_jp) AS tables,
count(DISTINCT module_name) AS modules FROM crud""", "crud")
def _catalog(f):
    return f.crud().agg(F.count(F.lit(1)).alias("records"), F.countDistinct("ajs_name").alias("jobs"),
                        F.countDistinct("table_name_jp").alias("tables"), F.countDistinct("module_name").alias("modules"))


@query("impact_closure", """WITH RECURSIVE r AS (SELECT DISTINCT table_name_jp AS t, ajs_name AS j FROM crud WHERE crud_r_flag = 1),
w AS (SELECT DISTINCT table_name_jp AS t, ajs_name AS j FROM crud WHERE crud_c_flag = 1 OR crud_u_flag = 1 OR crud_d_flag = 1),
e AS (SELECT DISTINCT r.t AS a, w.t AS b FROM r JOIN w USING (j)),
x AS (SELECT 'T_7' AS t, 0 AS d UNION SELECT e.b, x.d + 1 FROM x JOIN e ON e.a = x.t WHERE x.d < (SELECT count(DISTINCT b) FROM e))
SELECT t AS table_name_jp, CAST(min(d) AS INT) AS depth, TRUE AS is_complete FROM x GROUP BY 1""", "crud")
def _closure(f):
    c = f.crud()
    return impact.impact_closure(c, c.where("table_name_jp = 'T_7'"))


RULES = {**impact.TOOL_KEYWORDS, "metric_tool": ["tion", "the"], "document_tool": ["ung", "und", "de la"]}


def _tool_sql(tool: str) -> str:
    cond = " OR ".join(f"contains(text, '{w}')" for w in RULES[tool])
    return f"CASE WHEN {cond} THEN '{tool}' END"


@query("route_question", f"""SELECT conv_id, turn, tools, CASE WHEN len(tools) = 0 THEN 'none' WHEN len(tools) = 1 THEN tools[1] ELSE 'both' END AS route
FROM (SELECT conv_id, turn, list_sort(list_filter([{', '.join(_tool_sql(t) for t in RULES)}], lambda x: x IS NOT NULL)) AS tools FROM conversations WHERE role = 'user')""")
def _route(f):
    q = f.conversations.where("role = 'user'").select("conv_id", "turn", "text")
    return impact.route(q, "text", RULES).select("conv_id", "turn", "tools", "route")


@query("verified_query_lookup", f"""WITH q AS (SELECT conv_id, turn, list_distinct({WORDS.format('text')}) AS qt FROM conversations WHERE role = 'user'),
s AS (SELECT item_id AS stored_id, list_distinct({WORDS.format('text')}) AS st FROM benchmark),
x AS (SELECT conv_id, turn, stored_id, len(list_intersect(qt, st)) AS b, len(qt) AS nq, len(st) AS ns FROM q CROSS JOIN s),
r AS (SELECT conv_id, turn, stored_id, round(b::DOUBLE / greatest(nq + ns - b, 1), 6) AS score FROM x
QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY score DESC, stored_id) = 1)
SELECT conv_id, turn, CASE WHEN score >= 0.05 THEN stored_id END AS stored_id, score FROM r""")
def _lookup(f):
    q = f.conversations.where("role = 'user'").select("conv_id", "turn", "text")
    return similarity.best_match(q, ["conv_id", "turn"], tokens("text"), f.benchmark, "item_id", tokens("text"), 0.05)
