"""Evaluation of answers, the answer log and reply streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions import dates
from lakeloom.functions.numbers import count_if, dbl, exact_avg, pct
from lakeloom.operators import evaluation, sets
from lakeloom.operators.aggregates import exact_percentile, histogram
from lakeloom.operators.topk import top
from lakeloom.plans.registry import query
from lakeloom.plans.search import SCORES, VQ, label_topk, ranked_sql
from lakeloom.session import shared_dir
from lakeloom.sources.inline import values_relation

# answer sets: expected = vectors of the query's label, returned = cosine top 10
SETS = f"""WITH e AS (SELECT q.query_id, v.vec_id AS item FROM vectors v JOIN query_vectors q ON v.label = q.label),
r AS (SELECT query_id, vec_id AS item FROM {ranked_sql(SCORES, 10, "query_id, vec_id", "score DESC, vec_id")}),
c AS (SELECT coalesce(e.query_id, r.query_id) AS query_id, count(e.item) AS n_expected, count(r.item) AS n_returned,
count(CASE WHEN e.item IS NOT NULL AND r.item IS NOT NULL THEN 1 END) AS n_hit FROM e FULL JOIN r ON e.query_id = r.query_id AND e.item = r.item GROUP BY 1)"""


def case_frame(f):
    q = f.query_vectors().select("label", "query_id")
    expected = f.embeddings.select("vec_id", "label").join(q, "label").select("query_id", F.col("vec_id").alias("item"))
    returned = label_topk(f, 10).select("query_id", F.col("item_id").alias("item"))
    return sets.case_scores(expected, returned, "query_id", "item")


@query("exact_match", SETS + " SELECT query_id, n_hit = n_expected AND n_hit = n_returned AS exact_match FROM c", VQ)
def _exact(f):
    return case_frame(f).select("query_id", "exact_match")


@query("macro_recall", SETS + """ SELECT count(*) AS cases, round(CAST(sum(CAST(n_hit::DOUBLE / n_expected AS DECIMAL(20,10))) AS DOUBLE) / count(*), 4) AS mean_recall,
round(count(CASE WHEN n_hit = n_expected AND n_hit = n_returned THEN 1 END)::DOUBLE / count(*), 4) AS exact_match_rate FROM c""", VQ)
def _recall(f):
    return sets.macro_scores(case_frame(f)).drop("mean_precision")


@query("macro_precision", SETS + """ SELECT count(*) AS cases, round(CAST(sum(CAST(CASE WHEN n_returned > 0 THEN n_hit::DOUBLE / n_returned ELSE 0 END AS DECIMAL(20,10))) AS DOUBLE)
/ count(*), 4) AS mean_precision FROM c""", VQ)
def _precision(f):
    return sets.macro_scores(case_frame(f)).select("cases", "mean_precision")


@query("mean_relevance", "SELECT category, tool_type, round(CAST(sum(relevance_score) AS DOUBLE) / count(*), 2) AS mean_relevance FROM eval_results GROUP BY 1, 2", "eval_results")
def _relevance(f):
    return f.eval_results().groupBy("category", "tool_type").agg(F.round(exact_avg("relevance_score"), 2).alias("mean_relevance"))


@query("tool_match", "SELECT tool_type, round(count(CASE WHEN tool_match THEN 1 END) * 100.0::DOUBLE / count(*), 1) AS tool_match_pct FROM eval_results WHERE category = 'E' GROUP BY 1", "eval_results")
def _tool_match(f):
    return f.eval_results().where("category = 'E'").groupBy("tool_type").agg(
        pct(count_if(F.col("tool_match")), F.count(F.lit(1))).alias("tool_match_pct"))


SUMMARY = """SELECT category, tool_type, count(*) AS total_cases,
round(count(CASE WHEN is_correct THEN 1 END) * 100.0::DOUBLE / count(*), 1) AS accuracy_pct,
round(CAST(sum(recall_score) AS DOUBLE) / count(*) * 100, 1) AS avg_recall_pct, round(CAST(sum(precision_score) AS DOUBLE) / count(*) * 100, 1) AS avg_precision_pct,
round(CAST(sum(relevance_score) AS DOUBLE) / count(*), 2) AS avg_relevance_score, round(CAST(sum(response_sec) AS DOUBLE) / count(*), 2) AS avg_response_sec
FROM eval_results GROUP BY category, tool_type"""


@query("eval_summary", SUMMARY, "eval_results")
def _summary(f):
    return evaluation.eval_summary(f.eval_results(), ["category", "tool_type"])


COMPARE = """SELECT tool_type, round(count(CASE WHEN category IN ('A', 'B') AND is_correct THEN 1 END) * 100.0::DOUBLE / count(*), 1) AS impact_accuracy_pct,
round(CAST(sum(CASE WHEN category IN ('C', 'D') THEN relevance_score END) AS DOUBLE) / count(CASE WHEN category IN ('C', 'D') THEN 1 END), 2) AS code_search_score,
round(count(CASE WHEN category = 'E' AND tool_match THEN 1 END) * 100.0::DOUBLE / count(*), 1) AS tool_routing_accuracy_pct,
round(quantile_cont(CAST(response_sec AS DOUBLE), 0.95), 2) AS p95_response_sec FROM eval_results GROUP BY 1"""


@query("eval_compare", COMPARE, "eval_results")
def _compare(f):
    return evaluation.eval_compare(f.eval_results())


@query("eval_improvement", f"""SELECT category, max(CASE WHEN tool_type = 'search_only' THEN accuracy_pct END) AS search_only,
max(CASE WHEN tool_type = 'hybrid' THEN accuracy_pct END) AS hybrid, round(max(CASE WHEN tool_type = 'hybrid' THEN accuracy_pct END)
- max(CASE WHEN tool_type = 'search_only' THEN accuracy_pct END), 2) AS difference FROM ({SUMMARY}) GROUP BY 1""", "eval_results")
def _improvement(f):
    s = evaluation.eval_summary(f.eval_results(), ["category", "tool_type"])
    return evaluation.improvement(s, ["category"], "accuracy_pct", "search_only", "hybrid")


@query("score_histogram", """SELECT t.tool_type, CAST(b.relevance_score AS INT) AS relevance_score, count(e.test_case_id) AS n
FROM (SELECT DISTINCT tool_type FROM eval_results) t CROSS JOIN (VALUES (1), (2), (3), (4), (5), (6)) b(relevance_score)
LEFT JOIN eval_results e ON e.tool_type = t.tool_type AND e.relevance_score = b.relevance_score GROUP BY 1, 2""", "eval_results")
def _histogram(f):
    return histogram(f.eval_results(), ["tool_type"], "relevance_score", [1, 2, 3, 4, 5, 6])


@query("latency_stats", """SELECT tool_type, round(CAST(sum(response_sec) AS DOUBLE) / count(*), 2) AS avg_sec,
round(quantile_cont(CAST(response_sec AS DOUBLE), 0.95), 2) AS p95_sec, CAST(max(response_sec) AS DOUBLE) AS max_sec FROM eval_results GROUP BY 1""", "eval_results")
def _latency(f):
    r = f.eval_results()
    g = r.groupBy("tool_type").agg(F.round(exact_avg("response_sec"), 2).alias("avg_sec"), F.max("response_sec").cast("double").alias("max_sec"))
    p = exact_percentile(r, ["tool_type"], "response_sec", 0.95, "p")
    return g.join(p.select("tool_type", F.round("p", 2).alias("p95_sec")), "tool_type")


@query("case_diff", """SELECT a.test_case_id, a.category, a.is_correct AS base_ok, b.is_correct AS other_ok, CASE WHEN a.is_correct AND NOT b.is_correct THEN 'worse'
WHEN NOT a.is_correct AND b.is_correct THEN 'better' ELSE 'same' END AS outcome FROM eval_results a JOIN eval_results b ON a.test_case_id = b.test_case_id
AND a.tool_type = 'search_only' AND b.tool_type = 'hybrid'""", "eval_results")
def _case_diff(f):
    return evaluation.case_diff(f.eval_results(), "search_only", "hybrid")


# Goals of the evaluation. ``gain`` goals compare hybrid with search_only.
GOALS = [("impact_accuracy_gain_pct", ">=", 20.0), ("code_search_change_pct", ">=", -5.0), ("p95_response_sec", "<=", 10.0),
         ("tool_routing_accuracy_pct", ">=", 90.0)]


@query("kpi_goal_check", f"""WITH c AS ({COMPARE}), p AS (SELECT
max(CASE WHEN tool_type = 'hybrid' THEN impact_accuracy_pct END) AS ih, max(CASE WHEN tool_type = 'search_only' THEN impact_accuracy_pct END) AS ib,
max(CASE WHEN tool_type = 'hybrid' THEN code_search_score END) AS ch, max(CASE WHEN tool_type = 'search_only' THEN code_search_score END) AS cb,
max(CASE WHEN tool_type = 'hybrid' THEN p95_response_sec END) AS ph, max(CASE WHEN tool_type = 'hybrid' THEN tool_routing_accuracy_pct END) AS th FROM c),
k AS (SELECT 'impact_accuracy_gain_pct' AS kpi, round((ih - ib) * 100.0::DOUBLE / ib, 1) AS actual, 20.0::DOUBLE AS goal, '>=' AS op FROM p
UNION ALL SELECT 'code_search_change_pct', round((ch - cb) * 100.0::DOUBLE / cb, 1), -5.0::DOUBLE, '>=' FROM p
UNION ALL SELECT 'p95_response_sec', ph, 10.0::DOUBLE, '<=' FROM p UNION ALL SELECT 'tool_routing_accuracy_pct', th, 90.0::DOUBLE, '>=' FROM p)
SELECT kpi, actual, goal, CASE op WHEN '>=' THEN actual >= goal ELSE actual <= goal END AS reached FROM k""", "eval_results")
def _goals(f):
    c = evaluation.eval_compare(f.eval_results())
    def tool(col, t):
        return F.max(F.when(F.col("tool_type") == t, F.col(col)))
    def gain(col):
        return pct(tool(col, "hybrid") - tool(col, "search_only"), tool(col, "search_only"))
    k = c.agg(gain("impact_accuracy_pct").alias("impact_accuracy_gain_pct"), gain("code_search_score").alias("code_search_change_pct"),
              tool("p95_response_sec", "hybrid").alias("p95_response_sec"), tool("tool_routing_accuracy_pct", "hybrid").alias("tool_routing_accuracy_pct"))
    long = k.select(F.expr("stack(4, " + ", ".join(f"'{g[0]}', {g[0]}" for g in GOALS) + ") as (kpi, actual)"))
    goals = values_relation(f.spark, ["kpi", "op", "goal"], GOALS)
    return long.join(goals, "kpi").select("kpi", "actual", "goal", F.when(F.col("op") == ">=", F.col("actual") >= F.col("goal")).otherwise(
        F.col("actual") <= F.col("goal")).alias("reached"))


@query("result_compare", """WITH a AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1)
SELECT (SELECT count(*) FROM (FROM a EXCEPT ALL FROM b)) AS only_left, (SELECT count(*) FROM (FROM b EXCEPT ALL FROM a)) AS only_right, FALSE AS equal""")
def _result_compare(f):
    a = f.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    b = f.orders.where("o_orderstatus <> 'P'").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return sets.result_diff(a, b)


DAILY_SQL = """SELECT CAST(logged_at AS DATE) AS date, count(*) AS query_count, round(CAST(sum(max_similarity) AS DOUBLE) / count(max_similarity), 4) AS avg_max_similarity,
round(CAST(sum(latency_ms) AS DOUBLE) / count(latency_ms), 0) AS avg_latency_ms, count(CASE WHEN user_feedback = 'good' THEN 1 END) AS good_count,
count(CASE WHEN user_feedback = 'bad' THEN 1 END) AS bad_count FROM quality_log GROUP BY 1"""


@query("rag_daily_stats", DAILY_SQL, "quality_log")
def _daily(f):
    return evaluation.daily_stats(f.quality_log()).orderBy(F.col("date").desc())


@query("satisfaction_rate", """SELECT CAST(date_trunc('week', logged_at) AS DATE) AS week, count(user_feedback) AS rated,
round(count(CASE WHEN user_feedback = 'good' THEN 1 END) * 100.0::DOUBLE / nullif(count(user_feedback), 0), 1) AS satisfaction_pct FROM quality_log GROUP BY 1""", "quality_log")
def _satisfaction(f):
    rated = F.count("user_feedback")
    return f.quality_log().groupBy(F.trunc("logged_at", "week").alias("week")).agg(
        rated.alias("rated"), pct(count_if(F.col("user_feedback") == "good"), rated).alias("satisfaction_pct"))


@query("low_quality_queries", """SELECT log_id, query, CAST(max_similarity AS DOUBLE) AS max_similarity, user_feedback FROM quality_log
WHERE (max_similarity < 0.6 OR user_feedback = 'bad') AND logged_at >= TIMESTAMP '2024-01-23' ORDER BY max_similarity, log_id LIMIT 20""", "quality_log")
def _low_quality(f):
    q = f.quality_log().where(dates.recent("logged_at", f.events_as_of, days=7) & (
        (F.col("max_similarity") < 0.6) | F.coalesce(F.col("user_feedback") == "bad", F.lit(False))))
    return top(q.select("log_id", "query", dbl("max_similarity").alias("max_similarity"), "user_feedback"),
               [F.col("max_similarity"), F.col("log_id")], 20)


@query("quality_log_append")
def _log_append(f):
    from lakeloom.sources.writers import insert_select
    path = shared_dir(f.spark, "quality-log")
    cols = ["log_key", "query", "max_similarity", "latency_ms", "user_feedback", "logged_at"]
    insert_select(f.quality_log().drop("logged_at"), path, cols, {"log_key": F.uuid(), "logged_at": F.current_timestamp()})
    return f.spark.read.parquet(path).groupBy("user_feedback").count()


@query("query_history", """SELECT log_id, query, CAST(latency_ms AS DOUBLE) / 1000 AS exec_sec FROM quality_log WHERE query LIKE '%view%' OR query LIKE '%click%'
ORDER BY logged_at DESC, log_id LIMIT 20""", "quality_log")
def _query_history(f):
    q = f.quality_log().where(F.col("query").like("%view%") | F.col("query").like("%click%"))
    return top(q, [F.col("logged_at").desc(), F.col("log_id")], 20).select("log_id", "query", (dbl("latency_ms") / 1000).alias("exec_sec"))


@query("tool_use_log", "SELECT user_id, CAST(ts AS DATE) AS day, list_sort(list(DISTINCT event_type)) AS tools FROM events GROUP BY 1, 2")
def _tools(f):
    return f.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.sort_array(F.collect_set("event_type")).alias("tools"))


@query("event_log_answer", """WITH x AS (SELECT user_id, CAST(ts AS DATE) AS day, event_id, event_type, props, value > 450 AND event_type = 'purchase' AS done FROM events),
y AS (SELECT *, min(CASE WHEN done THEN event_id END) OVER (PARTITION BY user_id, day) AS stop FROM x WHERE event_type <> 'signup')
SELECT user_id, day, coalesce(string_agg(CASE WHEN event_type = 'view' AND (stop IS NULL OR event_id < stop) THEN 'part ' || event_id || '; ' END, '' ORDER BY event_id), '') AS answer,
list_filter(list(CASE WHEN event_type = 'click' AND (stop IS NULL OR event_id < stop) THEN 'tool ' || props END ORDER BY event_id), lambda x: x IS NOT NULL) AS used_tools
FROM y GROUP BY 1, 2""")
def _event_answer(f):
    """A reply stream per user and day: deltas, tool calls, broken lines, keep-alives and end marks."""
    e, num = F.col("event_type"), F.col("event_id").cast("string")
    delta = F.to_json(F.struct(F.lit("content_block_delta").alias("type"), F.struct(
        F.lit("text_delta").alias("type"), F.concat(F.lit("part "), num, F.lit("; ")).alias("text")).alias("delta")))
    tool = F.to_json(F.struct(F.lit("tool_use").alias("type"), F.concat(F.lit("tool "), "props").alias("name")))
    line = F.when(e == "view", F.concat(F.lit("data: "), delta)).when(e == "click", F.concat(F.lit("data: "), tool)) \
        .when(e == "error", F.lit("data: {broken")).when((e == "purchase") & (F.col("value") > 450), F.lit("data: [DONE]")) \
        .when(e == "purchase", F.lit('data: {"type": "ping"}')).otherwise(F.lit(": keep-alive"))
    lines = f.events.select("user_id", F.to_date("ts").alias("day"), "event_id", line.alias("line"))
    return evaluation.answer_from_events(lines, ["user_id", "day"], "event_id", "line")
