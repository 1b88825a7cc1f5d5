"""Scalar, JSON, array and vector functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lakeloom.functions.text import lines
from lakeloom.functions.vectors import cosine, has_dim
from lakeloom.operators.retrieval import search_content
from lakeloom.plans.registry import drawn_sql, query


@query("concat_coalesce", """SELECT source_id, ai_summary || ' / ' || module_name AS piped,
coalesce(ai_summary, '') || ' / ' || coalesce(module_name, '') AS guarded FROM src""", "src")
def _concat(f):
    return f.src().select("source_id", F.concat("ai_summary", F.lit(" / "), "module_name").alias("piped"),
                          F.concat(F.coalesce("ai_summary", F.lit("")), F.lit(" / "),
                                   F.coalesce("module_name", F.lit(""))).alias("guarded"))


@query("text_preview", """SELECT doc_id, left(text, 50) AS preview, length(text) AS n_text, length(trim(text)) AS n_trimmed FROM documents""")
def _preview(f):
    return f.documents.select("doc_id", F.left("text", F.lit(50)).alias("preview"),
                              F.length("text").cast("long").alias("n_text"),
                              F.length(F.trim("text")).cast("long").alias("n_trimmed"))


@query("split_lines", "SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents")
def _split(f):
    return f.documents.select("doc_id", lines("text").alias("parts"))


@query("lpad_id", "SELECT o_orderkey, 'ORD-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS order_id FROM orders")
def _lpad(f):
    return f.orders.select("o_orderkey", F.concat(F.lit("ORD-"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("order_id"))


@query("escape_quotes", "SELECT page_id, replace(html, '''', '''''') AS escaped FROM pages")
def _escape(f):
    return f.pages.select("page_id", F.replace("html", F.lit("'"), F.lit("''")).alias("escaped"))


@query("text_cap", "SELECT doc_id, left(text, 400) AS excerpt, length(left(text, 8000)) AS prompt_chars FROM documents")
def _cap(f):
    return f.documents.select("doc_id", F.substring("text", 1, 400).alias("excerpt"),
                              F.length(F.substring("text", 1, 8000)).cast("long").alias("prompt_chars"))


@query("round_k", "SELECT event_id, CAST(round(CAST(value AS DECIMAL(18,2)), 1) AS DOUBLE) AS r1, CAST(round(CAST(value AS DECIMAL(18,2)), 0) AS DOUBLE) AS r0 FROM events")
def _round(f):
    v = F.col("value").cast("decimal(18,2)")
    return f.events.select("event_id", F.round(v, 1).cast("double").alias("r1"), F.round(v, 0).cast("double").alias("r0"))


@query("null_guards", """SELECT user_id, round(100.0::DOUBLE / nullif(count(CASE WHEN value > 485 THEN 1 END), 0), 2) AS guarded,
coalesce(max(CASE WHEN value > 485 THEN event_type END), 'none') AS kind FROM events GROUP BY 1""")
def _guards(f):
    big = F.col("value") > 485
    return f.events.groupBy("user_id").agg(
        F.round(F.lit(100.0) / F.nullif(F.count(F.when(big, 1)), F.lit(0)), 2).alias("guarded"),
        F.coalesce(F.max(F.when(big, F.col("event_type"))), F.lit("none")).alias("kind"))


@query("casts", """SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS as_text, CAST(CAST(o_orderkey AS VARCHAR) AS DOUBLE) AS as_float,
CAST(o_orderdate AS DATE) AS as_date, CAST(CAST(o_totalprice / 1000000 AS DECIMAL(3,2)) AS DOUBLE) AS as_number,
TRY_CAST(o_orderpriority AS INT) AS not_a_number FROM orders""")
def _casts(f):
    k = F.col("o_orderkey").cast("string")
    return f.orders.select("o_orderkey", k.alias("as_text"), k.cast("double").alias("as_float"),
                           F.to_date("o_orderdate").alias("as_date"),
                           (F.col("o_totalprice") / 1000000).cast("decimal(3,2)").cast("double").alias("as_number"),
                           F.col("o_orderpriority").try_cast("int").alias("not_a_number"))


@query("date_trunc", """SELECT event_id, date_trunc('day', ts) AS day_ts, CAST(date_trunc('month', ts) AS DATE) AS month,
CAST(date_trunc('day', ts) AS DATE) AS day FROM events""")
def _trunc(f):
    return f.events.select("event_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day_ts"),
                           F.trunc("ts", "month").alias("month"), F.to_date("ts").alias("day"))


@query("date_add", """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + INTERVAL 3 DAY AS DATE) AS plus_days,
CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH AS DATE) AS month_before, o_orderdate - INTERVAL 5 MINUTE AS minutes_before FROM orders""")
def _date_add(f):
    d = F.to_date("o_orderdate")
    return f.orders.select("o_orderkey", F.date_add(d, 3).alias("plus_days"), F.add_months(d, -1).alias("month_before"),
                           (F.col("o_orderdate") - F.expr("INTERVAL 5 MINUTES")).alias("minutes_before"))


@query("date_parts", "SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month FROM orders")
def _parts(f):
    return f.orders.select("o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))


@query("as_of_param", """SELECT count(*) AS n, DATE '2001-07-15' AS as_of, 'ANALYST' AS principal FROM orders
WHERE o_orderdate >= DATE '2001-07-15' - INTERVAL 30 DAY AND o_orderdate < DATE '2001-07-16'""")
def _as_of(f):
    from lakeloom.functions.dates import between_dates
    start, end = f.as_of - dt.timedelta(days=30), f.as_of + dt.timedelta(days=1)
    return f.orders.where(between_dates("o_orderdate", start, end)).agg(
        F.count(F.lit(1)).alias("n"), F.lit(f.as_of).alias("as_of"), F.lit("ANALYST").alias("principal"))


@query("generate_orders", f"""WITH p AS (SELECT *, row_number() OVER (ORDER BY {drawn_sql("'pool'", 'product_id')}, product_id) - 1 AS pick FROM products),
k AS (SELECT c_custkey AS k, {drawn_sql(42, 'c_custkey')} % (SELECT count(*) FROM products) AS pick, CAST({drawn_sql(43, 'c_custkey')} % 5 + 1 AS INTEGER) AS quantity,
  {drawn_sql(44, 'c_custkey')} % 10 + 1 AS s, {drawn_sql(45, 'c_custkey')} % 3 AS r, CAST({drawn_sql(46, 'c_custkey')} % 365 AS INTEGER) AS d FROM customer)
SELECT 'ORD-' || lpad(CAST(k AS VARCHAR), 12, '0') AS order_id, DATE '2024-01-01' + d AS order_date, product_id, product_name, category, quantity,
  list_price AS unit_price, quantity * list_price AS total_amount, CASE r WHEN 0 THEN 'EAST' WHEN 1 THEN 'WEST' ELSE 'OVERSEAS' END AS region,
  CASE s WHEN 1 THEN 'cancelled' WHEN 2 THEN 'pending' ELSE 'completed' END AS status FROM k JOIN p USING (pick)""", "products")
def _generate(f):
    """Synthetic orders, one per customer, with seeded draws joined to the products table."""
    from lakeloom.operators.generate import synthetic_orders
    return synthetic_orders(f.customer.select("c_custkey"), f.products(), dt.date(2024, 1, 1), 365, seed=42)


@query("uuid_key")
def _uuid(f):
    return f.events.select("event_id", F.uuid().alias("log_key"))


@query("int_vs_decimal_div", """SELECT l_orderkey, l_linenumber, l_partkey, l_partkey * 8 // 1024 AS int_div, l_partkey * 8 / 1024 AS real_div FROM lineitem""")
def _div(f):
    p = F.col("l_partkey") * 8
    return f.lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                             F.expr("l_partkey * 8 div 1024").alias("int_div"), (p / 1024).alias("real_div"))


@query("object_name_lookup", """SELECT l_orderkey, l_linenumber, l_partkey, 'dbo.' || p_name AS object_name FROM lineitem
JOIN part ON l_partkey = p_partkey WHERE l_quantity > 45""")
def _object_name(f):
    li = f.lineitem.where("l_quantity > 45").select("l_orderkey", "l_linenumber", "l_partkey")
    return li.join(f.part.select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.concat(F.lit("dbo."), "p_name").alias("object_name"))


# ---- JSON, arrays, vectors ---------------------------------------------------------------------

@query("parse_json", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def _parse_json(f):
    return f.events.select("event_id", F.variant_get(F.parse_json("props"), "$.k", "bigint").alias("k"))


def reply_json():
    """A model reply per event: text item, then a statement item, plus warnings."""
    item = F.struct(F.lit("text").alias("type"), F.col("event_type").alias("text"), F.lit(None).cast("string").alias("statement"))
    stmt = F.struct(F.lit("sql").alias("type"), F.lit(None).cast("string").alias("text"),
                    F.concat(F.lit("SELECT "), F.col("event_id").cast("string")).alias("statement"))
    content = F.when(F.col("event_type") == "error", F.array(item)).otherwise(F.array(item, stmt))
    warn = F.when(F.col("value") > 300, F.array(F.lit("slow"), F.lit("costly"))).otherwise(F.array().cast("array<string>"))
    return F.to_json(F.struct(F.struct(content.alias("content")).alias("message"), warn.alias("warnings")))


REPLY = "message struct<content: array<struct<type: string, text: string, statement: string>>>, warnings array<string>"


@query("json_path", "SELECT event_id, event_type AS first_text, 'text' AS first_type, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def _json_path(f):
    r = f.events.select("event_id", "props", reply_json().alias("reply"))
    return r.select("event_id", F.get_json_object("reply", "$.message.content[0].text").alias("first_text"),
                    F.get_json_object("reply", "$.message.content[0].type").alias("first_type"),
                    F.get_json_object("props", "$['k']").cast("int").alias("k"))


@query("json_results_explode", """SELECT event_id, 0 AS pos, 'text' AS type FROM events
UNION ALL SELECT event_id, 1, 'sql' FROM events WHERE event_type <> 'error'""")
def _json_explode(f):
    r = f.events.select("event_id", F.from_json(reply_json(), REPLY).alias("r"))
    return r.select("event_id", F.posexplode("r.message.content").alias("pos", "item")).select("event_id", "pos", "item.type")


@query("array_size", "SELECT event_id, CAST(CASE WHEN value > 300 THEN 2 ELSE 0 END AS INT) AS warnings FROM events")
def _array_size(f):
    return f.events.select("event_id", F.size(F.from_json(reply_json(), REPLY)["warnings"]).alias("warnings"))


@query("first_sql_item", "SELECT event_id, CASE WHEN event_type <> 'error' THEN 'SELECT ' || event_id END AS statement FROM events")
def _first_sql(f):
    r = F.from_json(reply_json(), REPLY)["message"]["content"]
    return f.events.select("event_id", F.get(F.filter(r, lambda x: x["type"] == "sql"), F.lit(0))["statement"].alias("statement"))


@query("build_request_json", """SELECT item_id, json_extract_string(j, '$.query') AS query, json_extract_string(j, '$.columns[1]') AS second_column,
CAST(json_extract(j, '$.limit') AS INT) AS row_limit FROM (SELECT item_id,
to_json({'query': text, 'columns': ['content', 'doc_name'], 'limit': 3}) AS j FROM benchmark)""")
def _request(f):
    req = F.to_json(F.struct(F.col("text").alias("query"), F.array(F.lit("content"), F.lit("doc_name")).alias("columns"),
                             F.lit(3).alias("limit")))
    r = f.benchmark.select("item_id", req.alias("j"))
    return r.select("item_id", F.get_json_object("j", "$.query").alias("query"),
                    F.get_json_object("j", "$.columns[1]").alias("second_column"),
                    F.get_json_object("j", "$.limit").cast("int").alias("row_limit"))


@query("request_json_safe", """SELECT page_id, html || '"' AS query, TRUE AS valid FROM pages""")
def _request_safe(f):
    """Quotes in the text survive, unlike in a request put together by concatenation."""
    j = F.to_json(F.struct(F.concat("html", F.lit('"')).alias("query"), F.lit(3).alias("limit")))
    parsed = F.from_json(j, "query string, limit int")
    return f.pages.select("page_id", parsed["query"].alias("query"), (parsed["limit"] == 3).alias("valid"))


@query("vector_dim_check", "SELECT vec_id, CAST(len(embedding) AS INT) AS dim, len(embedding) = 64 AS ok FROM embeddings")
def _dim(f):
    return f.embeddings.select("vec_id", F.size("embedding").alias("dim"), has_dim("embedding", 64).alias("ok"))


@query("vector_peek", "SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS first_value, CAST(embedding[64] AS DOUBLE) AS last_value FROM embeddings")
def _peek(f):
    return f.embeddings.select("vec_id", F.element_at("embedding", 1).cast("double").alias("first_value"),
                               F.element_at("embedding", 64).cast("double").alias("last_value"))


@query("cosine", """SELECT v.vec_id, q.query_id, round(list_cosine_similarity(v.embedding, q.query_vec), 6) AS score
FROM vectors v JOIN query_vectors q ON v.label = q.label""", "vectors query_vectors")
def _cosine(f):
    return f.embeddings.join(f.query_vectors(), "label").select(
        "vec_id", "query_id", F.round(cosine("embedding", "query_vec"), 6).alias("score"))


@query("search_content", """SELECT source_id, ai_summary || ' モジュール名: ' || coalesce(module_name, '') || ' 機能名: '
|| coalesce(function_name, '') || ' ファイル名: ' || coalesce(file_name, '') || ' ジョブ名: ' || coalesce(ajs_name, '') AS search_content FROM src""", "src")
def _search_content(f):
    return f.src().select("source_id", search_content().alias("search_content"))
