"""Projections, filters, joins, aggregates, windows, limits and sets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lakeloom.functions import dates
from lakeloom.functions.numbers import count_if, dbl, exact_avg, pct, sum_if
from lakeloom.functions.text import lines
from lakeloom.operators import joins, sets
from lakeloom.operators.aggregates import exact_percentile, with_share
from lakeloom.operators.retrieval import ordered_text
from lakeloom.operators.sampling import seeded_pick
from lakeloom.operators.topk import history_arrays, last_messages, numbered, top, top_per_group
from lakeloom.plans.registry import drawn_sql, query
from lakeloom.sources.inline import values_relation

# ---- projections and filters -------------------------------------------------------------------


@query("project_alias", 'SELECT o_orderkey AS "Order No", o_custkey AS customer_id, o_totalprice AS total FROM orders')
def _project(f):
    return f.orders.select(F.col("o_orderkey").alias("Order No"), F.col("o_custkey").alias("customer_id"),
                           F.col("o_totalprice").alias("total"))


@query("filter_ne", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'")
def _ne(f):
    return f.orders.where(F.col("o_orderstatus") != "P").select("o_orderkey", "o_orderstatus")


@query("filter_in_list", """SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('P', 'F')""")
def _in(f):
    return f.orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
                          & ~F.col("o_orderstatus").isin("P", "F")).select(
        "o_orderkey", "o_orderpriority", "o_orderstatus")


@query("filter_like", """SELECT p_partkey, p_name FROM part
WHERE (p_name LIKE '%ring%' OR p_name LIKE '%plate%') AND p_name NOT LIKE 'red %'""")
def _like(f):
    n = F.col("p_name")
    return f.part.where((n.like("%ring%") | n.like("%plate%")) & ~n.like("red %")).select("p_partkey", "p_name")


@query("like_join", """SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b
ON d.text LIKE '%' || replace(replace(b.text, '%', ''), '_', '') || '%'""")
def _like_join(f):
    pats = f.benchmark.select("item_id", F.translate("text", "%_", "").alias("pattern"))
    hits = joins.contains_join(f.texts.select("doc_id", "text"), "text", pats, "pattern")
    return hits.select("doc_id", "item_id")


@query("filter_null", "SELECT source_id, module_name FROM src WHERE ai_summary IS NULL AND module_name IS NOT NULL", "src")
def _null(f):
    return f.src().where(F.col("ai_summary").isNull() & F.col("module_name").isNotNull()).select(
        "source_id", "module_name")


@query("filter_and_or", """SELECT ajs_name, table_name_jp FROM crud
WHERE (crud_c_flag = 1 OR crud_u_flag = 1 OR crud_d_flag = 1) AND file_o_flg = 0""", "crud")
def _and_or(f):
    c = F.col
    return f.crud().where(((c("crud_c_flag") == 1) | (c("crud_u_flag") == 1) | (c("crud_d_flag") == 1))
                          & (c("file_o_flg") == 0)).select("ajs_name", "table_name_jp")


@query("filter_short_lines", """SELECT doc_id, count(*) AS kept FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS c FROM documents) WHERE length(trim(c)) > 10 GROUP BY doc_id""")
def _short(f):
    x = f.documents.select("doc_id", F.explode(lines("text")).alias("c"))
    return x.where(F.length(F.trim("c")) > 10).groupBy("doc_id").agg(F.count(F.lit(1)).alias("kept"))


@query("filter_prev_month", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders
WHERE date_trunc('month', o_orderdate) = DATE '2001-06-01'""")
def _prev(f):
    return f.orders.where(dates.in_month("o_orderdate", f.as_of, -1)).select(
        "o_orderkey", F.to_date("o_orderdate").alias("order_date"))


@query("filter_this_year", "SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) = 2001")
def _year(f):
    return f.orders.where(dates.in_year("o_orderdate", f.as_of)).select("o_orderkey", "o_totalprice")


@query("filter_yoy_months", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders
WHERE month(o_orderdate) = 7 AND year(o_orderdate) IN (2000, 2001)""")
def _yoy_months(f):
    return f.orders.where(dates.in_month_or_year_ago("o_orderdate", f.as_of)).select(
        "o_orderkey", F.to_date("o_orderdate").alias("order_date"))


@query("filter_recent", """SELECT 'last_5_min' AS span, count(*) AS n FROM events
  WHERE ts >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 5 MINUTE
UNION ALL SELECT 'last_7_days', count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-23 00:00:00'
UNION ALL SELECT 'this_month', count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-01 00:00:00'""")
def _recent(f):
    now = f.events_as_of
    spans = {"last_5_min": dates.recent("ts", now, minutes=5), "last_7_days": dates.recent("ts", now, days=7),
             "this_month": F.col("ts") >= dates.wall_time(dates.month_start(now.date()))}
    wide = f.events.where(spans["this_month"]).agg(*[count_if(c).alias(n) for n, c in spans.items()])
    return wide.select(F.expr("stack(3, " + ", ".join(f"'{n}', {n}" for n in spans) + ") as (span, n)"))


@query("case_label", """SELECT event_id, CASE WHEN value >= 300 THEN 'high' WHEN value >= 100 THEN 'middle' ELSE 'low' END AS band,
  CASE event_type WHEN 'error' THEN 'bad' WHEN 'purchase' THEN 'good' END AS label,
  CASE WHEN user_id > 50 THEN 'new' ELSE 'old' END AS cohort FROM events""")
def _case(f):
    v, e = F.col("value"), F.col("event_type")
    return f.events.select(
        "event_id", F.when(v >= 300, "high").when(v >= 100, "middle").otherwise("low").alias("band"),
        F.when(e == "error", "bad").when(e == "purchase", "good").alias("label"),
        F.expr("if(user_id > 50, 'new', 'old')").alias("cohort"))


@query("domain_values", """SELECT o_orderpriority AS value, count(*) AS n,
  o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND min(o_orderdate) BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'
  AS in_domain FROM orders GROUP BY 1""")
def _domain(f):
    lo, hi = F.lit(dt.date(1995, 1, 1)), F.lit(dt.date(2001, 12, 31))
    return f.orders.groupBy(F.col("o_orderpriority").alias("value")).agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderdate").alias("first")).select(
        "value", "n", (F.col("value").isin("1-URGENT", "2-HIGH", "3-MEDIUM")
                       & F.col("first").between(lo, hi)).alias("in_domain"))


@query("literal_columns", "SELECT doc_id, 'demo-model' AS model, 'OK' AS status, CAST(1 AS INT) AS version FROM documents")
def _literal(f):
    return f.documents.select("doc_id", F.lit("demo-model").alias("model"), F.lit("OK").alias("status"),
                              F.lit(1).alias("version"))


# ---- joins -------------------------------------------------------------------------------------

@query("left_join_customer", """SELECT o_orderkey, c_name, c_mktsegment FROM orders LEFT JOIN
  (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey""")
def _left_customer(f):
    c = f.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return joins.lookup(f.orders.select("o_orderkey", "o_custkey"), c, "o_custkey").drop("o_custkey")


@query("left_join_product", """SELECT l_orderkey, l_linenumber, l_partkey, p_name FROM lineitem LEFT JOIN
  (SELECT * FROM part WHERE p_size > 5) ON l_partkey = p_partkey""")
def _left_product(f):
    p = f.part.where("p_size > 5").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return joins.lookup(f.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), p, "l_partkey")


@query("inner_join", """SELECT c_mktsegment, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def _inner(f):
    return f.orders.join(f.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))


@query("target_actual_join", """
SELECT t.target_year, t.target_month, t.region, t.category, CAST(t.target_amount AS DOUBLE) AS target_amount,
  CAST(sum(CASE WHEN s.status <> 'cancelled' THEN s.total_amount ELSE 0 END) AS DOUBLE) AS actual
FROM targets t LEFT JOIN sales s ON t.region = s.region AND t.category = s.category
  AND t.target_year = year(s.order_date) AND t.target_month = month(s.order_date)
GROUP BY ALL""", "sales targets")
def _target_join(f):
    from lakeloom.plans.business import actual_by_target_key
    actual = actual_by_target_key(f.sales("product", "geo"))
    keys = ["target_year", "target_month", "region", "category"]
    return f.targets().join(actual, keys, "left").select(
        *keys, dbl("target_amount").alias("target_amount"), F.coalesce(dbl("actual"), F.lit(0.0)).alias("actual"))


@query("join_fanout_check", """
WITH l AS (SELECT count(*) AS n FROM (SELECT region, category FROM sales GROUP BY 1, 2 HAVING count(*) > 1)),
r AS (SELECT count(*) AS n FROM (SELECT region, category FROM targets GROUP BY 1, 2 HAVING count(*) > 1))
SELECT l.n AS left_repeated_keys, r.n AS right_repeated_keys, CASE WHEN l.n > 0 AND r.n > 0 THEN 'N:M'
  WHEN l.n > 0 THEN 'N:1' WHEN r.n > 0 THEN '1:N' ELSE '1:1' END AS cardinality, NOT (l.n > 0 AND r.n > 0) AS safe
FROM l, r""", "sales targets")
def _fanout(f):
    return joins.fanout_check(f.sales("product", "geo"), f.targets(), ["region", "category"])


@query("full_join", """SELECT coalesce(d.doc_id, e.vec_id) AS doc_id, d.lang, e.label FROM (SELECT * FROM documents
WHERE lang <> 'en') d FULL JOIN embeddings e ON d.doc_id = e.vec_id""")
def _full(f):
    d = f.documents.where("lang <> 'en'").select("doc_id", "lang")
    return d.join(f.embeddings.select(F.col("vec_id").alias("doc_id"), "label"), "doc_id", "full_outer").select(
        "doc_id", "lang", "label")


@query("cross_join_grid", "SELECT target_year, target_month, region, category, CAST(target_amount AS DOUBLE) AS target_amount "
                          "FROM targets", "targets")
def _grid(f):
    return f.targets().withColumn("target_amount", dbl("target_amount"))


@query("self_join_pairs", """SELECT a.vec_id AS a_vec_id, b.vec_id AS b_vec_id, a.label = b.label AS same_label
FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id ORDER BY 1, 2 LIMIT 20""")
def _pairs(f):
    from lakeloom.operators.vectors import first_pairs
    p = first_pairs(f.embeddings, "vec_id", ["label"], 20)
    return p.select("a_vec_id", "b_vec_id", (F.col("a_label") == F.col("b_label")).alias("same_label"))


@query("anti_join", "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey "
                    "AND o_orderdate >= DATE '2001-01-01')")
def _anti(f):
    o = f.orders.where(dates.in_year("o_orderdate", f.as_of) | (F.col("o_orderdate") >= F.lit(dt.date(2002, 1, 1))))
    return f.customer.join(o, F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey", "c_name")


@query("semi_join", "SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def _semi(f):
    return f.documents.join(f.labels.where("toxic = 1"), "doc_id", "left_semi").select("doc_id", "source")


@query("lateral_explode", """SELECT doc_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INT) AS line_no,
  unnest(string_split(text, chr(10))) AS line FROM documents""")
def _explode(f):
    return f.documents.select("doc_id", F.posexplode(lines("text")).alias("line_no", "line"))


@query("seeded_row_join", f"""WITH p AS (SELECT p_partkey + 1 AS rn, p_name, p_retailprice, row_number() OVER (ORDER BY {drawn_sql("'pool'", 'p_partkey + 1')}, p_partkey) - 1 AS pick FROM part),
o AS (SELECT o_orderkey, {drawn_sql(42, 'o_orderkey')} % n AS pick FROM orders CROSS JOIN (SELECT count(*) AS n FROM part))
SELECT o_orderkey, rn, p_name, p_retailprice FROM o JOIN p USING (pick)""")
def _seeded(f):
    pool = f.part.select((F.col("p_partkey") + 1).alias("rn"), "p_name", "p_retailprice")
    return seeded_pick(f.orders.select("o_orderkey"), "o_orderkey", pool, "rn", 42)


# ---- aggregates --------------------------------------------------------------------------------

@query("count_rows", """SELECT count(*) AS n_rows, count(ai_summary) AS has_summary, count(*) - count(ai_summary) AS missing
FROM src""", "src")
def _count(f):
    return f.src().agg(F.count(F.lit(1)).alias("n_rows"), F.count("ai_summary").alias("has_summary")) \
        .withColumn("missing", F.col("n_rows") - F.col("has_summary"))


@query("count_distinct", """SELECT count(DISTINCT ajs_name) AS jobs, count(DISTINCT table_name_jp) AS tables,
count(DISTINCT module_name) AS modules FROM crud""", "crud")
def _count_distinct(f):
    return f.crud().agg(F.countDistinct("ajs_name").alias("jobs"), F.countDistinct("table_name_jp").alias("tables"),
                        F.countDistinct("module_name").alias("modules"))


@query("basic_aggs", """SELECT event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total,
round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value), 4) AS mean, min(value) AS lowest, max(value) AS highest
FROM events GROUP BY 1""")
def _basic(f):
    return f.events.groupBy("event_type").agg(
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"),
        F.round(exact_avg("value"), 4).alias("mean"), F.min("value").alias("lowest"), F.max("value").alias("highest"))


@query("conditional_aggs", """SELECT user_id,
CAST(sum(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS bought,
count(CASE WHEN event_type = 'error' THEN 1 END) AS errors,
round(CAST(sum(CASE WHEN event_type = 'purchase' AND value > 350 THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE)
 / nullif(count(CASE WHEN event_type = 'purchase' AND value > 350 THEN value END), 0), 4) AS avg_big FROM events GROUP BY 1""")
def _conditional(f):
    buy = F.col("event_type") == "purchase"
    return f.events.groupBy("user_id").agg(
        sum_if(buy, F.col("value").cast("decimal(18,2)")).cast("double").alias("bought"),
        count_if(F.col("event_type") == "error").alias("errors"),
        F.round(F.try_divide(
            F.sum(F.when(buy & (F.col("value") > 350), F.col("value").cast("decimal(18,2)"))).cast("double"),
            count_if(buy & (F.col("value") > 350))), 4).alias("avg_big"))


@query("ratio_pct", """SELECT user_id, round(count(CASE WHEN event_type = 'error' THEN 1 END) * 100.0::DOUBLE
/ nullif(count(CASE WHEN value > 250 THEN 1 END), 0), 2) AS errors_per_big_pct FROM events GROUP BY 1""")
def _ratio(f):
    return f.events.groupBy("user_id").agg(
        pct(count_if(F.col("event_type") == "error"), count_if(F.col("value") > 250), 2).alias("errors_per_big_pct"))


@query("group_by_month", """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n FROM orders GROUP BY 1""")
def _by_month(f):
    return f.orders.groupBy(dates.month_of("o_orderdate").alias("month")).agg(F.count(F.lit(1)).alias("n")).orderBy("month")


@query("group_by_multi", "SELECT category, tool_type, count(*) AS n, max(relevance_score) AS best FROM eval_results GROUP BY 1, 2",
       "eval_results")
def _multi(f):
    return f.eval_results().groupBy("category", "tool_type").agg(
        F.count(F.lit(1)).alias("n"), F.max("relevance_score").alias("best"))


@query("global_agg", """SELECT count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
max(o_orderdate) AS last_order FROM orders""")
def _global(f):
    return f.orders.agg(F.count(F.lit(1)).alias("n"),
                        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"),
                        F.max("o_orderdate").alias("last_order"))


@query("listagg_ordered", """SELECT user_id, string_agg(event_type || ':' || CAST(event_id AS VARCHAR), ' | ' ORDER BY rn) AS latest
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn <= 3 GROUP BY 1""")
def _listagg(f):
    last = top_per_group(f.events, ["user_id"], [F.col("ts").desc(), F.col("event_id")], 3)
    text = F.concat_ws(":", "event_type", F.col("event_id").cast("string"))
    return last.groupBy("user_id").agg(ordered_text(text, ["rn"], " | ").alias("latest"))


@query("listagg_or_null", """SELECT 'some' AS input, CASE WHEN count(*) = 0 THEN NULL ELSE string_agg(doc_id, ',' ORDER BY doc_id) END AS ids
FROM (SELECT CAST(doc_id AS VARCHAR) AS doc_id FROM documents WHERE lang = 'de' ORDER BY documents.doc_id LIMIT 5)
UNION ALL SELECT 'none', CASE WHEN count(*) = 0 THEN NULL ELSE string_agg(doc_id, ',') END
FROM (SELECT CAST(doc_id AS VARCHAR) AS doc_id FROM documents WHERE lang = 'xx' ORDER BY documents.doc_id LIMIT 5)""")
def _listagg_null(f):
    out = None
    for name, lang in (("some", "de"), ("none", "xx")):
        d = top(f.documents.where(F.col("lang") == lang), [F.col("doc_id")], 5)
        row = d.select(F.col("doc_id").cast("string")).agg(F.expr(
            "listagg(doc_id, ',') WITHIN GROUP (ORDER BY doc_id)").alias("ids")).select(F.lit(name).alias("input"), "ids")
        out = row if out is None else out.unionByName(row)
    return out


@query("p95", "SELECT tool_type, round(quantile_cont(CAST(response_sec AS DOUBLE), 0.95), 2) AS p95_response_sec "
              "FROM eval_results GROUP BY 1", "eval_results")
def _p95(f):
    return exact_percentile(f.eval_results(), ["tool_type"], "response_sec", 0.95, "p95_response_sec") \
        .withColumn("p95_response_sec", F.round("p95_response_sec", 2))


@query("select_distinct", "SELECT DISTINCT ajs_name, net_name FROM crud WHERE crud_u_flag = 1", "crud")
def _distinct(f):
    return f.crud().where("crud_u_flag = 1").select("ajs_name", "net_name").distinct()


@query("module_functions", """SELECT DISTINCT module_name, function_name, count(DISTINCT ajs_name) AS job_count
FROM crud GROUP BY module_name, function_name""", "crud")
def _module_functions(f):
    return f.crud().groupBy("module_name", "function_name").agg(F.countDistinct("ajs_name").alias("job_count"))


@query("boolean_avg_pct", """SELECT tool_type, round(avg(CASE WHEN is_correct THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100, 1) AS accuracy_pct
FROM eval_results GROUP BY 1""", "eval_results")
def _bool_avg(f):
    return f.eval_results().groupBy("tool_type").agg(
        pct(count_if(F.col("is_correct")), F.count(F.lit(1))).alias("accuracy_pct"))


@query("subset_avg", """SELECT tool_type,
round(count(CASE WHEN category IN ('A','B') AND is_correct THEN 1 END) * 100.0::DOUBLE / count(*), 1) AS as_written_pct,
round(count(CASE WHEN category IN ('A','B') AND is_correct THEN 1 END) * 100.0::DOUBLE
 / count(CASE WHEN category IN ('A','B') THEN 1 END), 1) AS subset_pct FROM eval_results GROUP BY 1""", "eval_results")
def _subset(f):
    sub = F.col("category").isin("A", "B")
    hit = count_if(sub & F.col("is_correct"))
    return f.eval_results().groupBy("tool_type").agg(
        pct(hit, F.count(F.lit(1))).alias("as_written_pct"), pct(hit, count_if(sub)).alias("subset_pct"))


@query("size_rollup", """SELECT l_suppkey % 8 AS database_id, CAST(sum(l_partkey) * 8 // 1024 // 1024 AS BIGINT) AS total_gb,
CAST(sum(l_partkey) * 8 // 1024 AS BIGINT) AS total_mb FROM lineitem GROUP BY 1""")
def _size(f):
    g = f.lineitem.groupBy((F.col("l_suppkey") % 8).alias("database_id")).agg(F.sum("l_partkey").alias("pages"))
    return g.select("database_id", F.expr("pages * 8 div 1024 div 1024").alias("total_gb"),
                    F.expr("pages * 8 div 1024").alias("total_mb"))


@query("correlated_scalar_agg", """SELECT s_suppkey, s_name, (SELECT CAST(sum(l_partkey) * 8 // 1024 AS BIGINT) FROM lineitem
WHERE l_suppkey = s_suppkey) AS size_mb FROM supplier""")
def _correlated(f):
    g = f.lineitem.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.expr("sum(l_partkey) * 8 div 1024").alias("size_mb"))
    return f.supplier.select("s_suppkey", "s_name").join(g, "s_suppkey", "left")


# ---- windows and limits ------------------------------------------------------------------------

def label_scores(f):
    """Same-label neighbours of each label's query vector, by cosine."""
    from lakeloom.functions.vectors import cosine
    q = f.query_vectors()
    return f.embeddings.join(q, "label").select(
        "query_id", "vec_id", F.round(cosine("embedding", "query_vec"), 6).alias("score"))


LABEL_SCORES = """(SELECT q.query_id, v.vec_id, round(list_cosine_similarity(v.embedding, q.query_vec), 6) AS score
FROM vectors v JOIN query_vectors q ON v.label = q.label)"""


@query("row_number_topk", f"""SELECT query_id, vec_id, score, rn FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id
ORDER BY score DESC, vec_id) AS INT) AS rn FROM {LABEL_SCORES}) WHERE rn <= 5""", "vectors query_vectors")
def _row_number(f):
    return top_per_group(label_scores(f), ["query_id"], [F.col("score").desc(), F.col("vec_id")], 5)


@query("topk_per_group", f"""SELECT query_id, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id
ORDER BY score DESC, vec_id) AS rn FROM {LABEL_SCORES}) WHERE rn <= 2""", "vectors query_vectors")
def _topk_group(f):
    return top_per_group(label_scores(f), ["query_id"], [F.col("score").desc(), F.col("vec_id")], 2).drop("rn")


@query("ref_number", f"""SELECT CAST(row_number() OVER (ORDER BY score DESC, query_id, vec_id) AS INT) AS ref_no, query_id, vec_id, score
FROM {LABEL_SCORES} WHERE query_id <> vec_id ORDER BY score DESC, query_id, vec_id LIMIT 4""", "vectors query_vectors")
def _ref(f):
    s = label_scores(f).where("query_id <> vec_id")
    return numbered(s, [F.col("score").desc(), F.col("query_id"), F.col("vec_id")], 4)


@query("share_of_total", """SELECT p_type, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 2) AS share_pct
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def _share(f):
    g = f.lineitem.join(f.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))
    return with_share(g, "n", "share_pct", 2)


@query("history_window", """SELECT conv_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn
FROM conversations) WHERE rn <= 20""")
def _history(f):
    return last_messages(f.conversations, "conv_id", "turn", 20).select("conv_id", "turn", "role")


@query("history_array", """SELECT conv_id, list({'turn': turn, 'role': role, 'text': text} ORDER BY turn) AS history
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM conversations) WHERE rn <= 20 GROUP BY 1""")
def _history_array(f):
    return history_arrays(f.conversations, "conv_id", "turn", ["role", "text"], 20)


@query("order_by_multi", """SELECT o_orderpriority, month, n FROM (SELECT o_orderpriority,
CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n FROM orders GROUP BY 1, 2) ORDER BY month, n DESC, o_orderpriority""")
def _order(f):
    return f.orders.groupBy("o_orderpriority", dates.month_of("o_orderdate").alias("month")).agg(
        F.count(F.lit(1)).alias("n")).orderBy(F.col("month").asc_nulls_last(), F.col("n").desc(), "o_orderpriority")


@query("limit_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
def _limit(f):
    return top(f.orders.select("o_orderkey", "o_totalprice"), [F.col("o_orderkey")], 10)


@query("topk_global", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 3")
def _topk(f):
    return top(f.orders.select("o_orderkey", "o_totalprice"), [F.col("o_totalprice").desc(), F.col("o_orderkey")], 3)


@query("bottom_k", "SELECT log_id, CAST(max_similarity AS DOUBLE) AS max_similarity FROM quality_log ORDER BY max_similarity, log_id LIMIT 20",
       "quality_log")
def _bottom(f):
    return top(f.quality_log().select("log_id", dbl("max_similarity").alias("max_similarity")),
               [F.col("max_similarity"), F.col("log_id")], 20)


@query("result_cap", """SELECT customer_id, CAST(sum(total_amount) AS DOUBLE) AS total FROM sales WHERE status <> 'cancelled' GROUP BY 1
ORDER BY total DESC, customer_id LIMIT 20""", "sales")
def _cap(f):
    g = f.sales().where("status <> 'cancelled'").groupBy("customer_id").agg(F.sum("total_amount").cast("double").alias("total"))
    return top(g, [F.col("total").desc(), F.col("customer_id")], 20)


# ---- sets --------------------------------------------------------------------------------------

@query("union_all", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in (
    "orders", "customer", "part", "documents", "events")))
def _union(f):
    return sets.union_all(*[getattr(f, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), "n")
                            for t in ("orders", "customer", "part", "documents", "events")])


@query("union_literals", """SELECT g.base, count(s_suppkey) AS n FROM (SELECT 'low' AS base, 0 AS lo, 3000 AS hi
UNION ALL SELECT 'mid', 3000, 7000 UNION ALL SELECT 'high', 7000, 100000) g LEFT JOIN supplier ON s_acctbal >= lo AND s_acctbal < hi GROUP BY 1""")
def _literals(f):
    v = values_relation(f.spark, ["base", "lo", "hi"], [("low", 0, 3000), ("mid", 3000, 7000), ("high", 7000, 100000)])
    band = F.when((F.col("s_acctbal") >= 0) & (F.col("s_acctbal") < 3000), "low").when(
        (F.col("s_acctbal") >= 3000) & (F.col("s_acctbal") < 7000), "mid").when(
        (F.col("s_acctbal") >= 7000) & (F.col("s_acctbal") < 100000), "high")
    n = f.supplier.groupBy(band.alias("base")).agg(F.count(F.lit(1)).alias("n"))
    return v.join(n, "base", "left").select("base", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


@query("set_equality", """
WITH e AS (SELECT DISTINCT table_name_jp AS c, ajs_name AS i FROM crud WHERE crud_u_flag = 1),
r AS (SELECT DISTINCT table_name_jp AS c, ajs_name AS i FROM crud WHERE crud_u_flag = 1 AND file_i_flg = 0)
SELECT coalesce(e.c, r.c) AS case_id, count(e.i) = count(r.i) AND count(*) = count(e.i) AS exact_match
FROM e FULL JOIN r ON e.c = r.c AND e.i = r.i GROUP BY 1""", "crud")
def _set_eq(f):
    c = f.crud().where("crud_u_flag = 1").select(F.col("table_name_jp").alias("case_id"), "ajs_name", "file_i_flg")
    s = sets.case_scores(c, c.where("file_i_flg = 0"), "case_id", "ajs_name")
    return s.select("case_id", "exact_match")


