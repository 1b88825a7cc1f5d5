"""Business frames derived from the driver tables, with the same definition in ANSI SQL.

``sales`` joins only the dimensions a query asks for: with inner joins Catalyst may not drop an
unused dimension on its own, so the choice is made here.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.sources.tables import Tables, spread

AS_OF = dt.date(2001, 7, 15)          # business date of the sales questions
EVENTS_AS_OF = dt.datetime(2024, 1, 30)  # business time of the log questions

MONEY = "decimal(18,2)"

STATUS_SQL = "CASE o_orderstatus WHEN 'P' THEN 'cancelled' WHEN 'O' THEN 'pending' ELSE 'completed' END"
FLAG_EVENTS = {  # event type that sets each usage flag
    "crud_c_flag": "signup",
    "crud_r_flag": "view",
    "crud_u_flag": "click",
    "crud_d_flag": "error",
    "file_o_flg": "purchase",
}


class Frames(Tables):
    """Tables plus the derived frames used by the registered queries."""

    as_of = AS_OF
    events_as_of = EVENTS_AS_OF

    @property
    def texts(self) -> DataFrame:
        """Documents for word-level work."""
        return spread(self.documents)

    def sales(self, *dims: str) -> DataFrame:
        """Order lines. ``dims`` picks the joins: ``product``, ``customer``, ``geo``."""
        o = self.orders.select(
            "o_orderkey",
            F.col("o_custkey").alias("customer_id"),
            F.to_date("o_orderdate").alias("order_date"),
            F.expr(STATUS_SQL).alias("status"),
        )
        li = self.lineitem.select(
            "l_orderkey",
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("decimal(18,0)").alias("quantity"),
            F.col("l_extendedprice").cast(MONEY).alias("total_amount"),
            (F.col("l_returnflag") == "R").alias("returned"),
        )
        out = li.join(o, li.l_orderkey == o.o_orderkey).drop("l_orderkey", "o_orderkey")
        if "product" in dims:
            out = out.join(
                self.part.select(F.col("p_partkey").alias("product_id"),
                                 F.col("p_name").alias("product_name"),
                                 F.col("p_type").alias("category")),
                "product_id")
        if "customer" in dims or "geo" in dims:
            c = self.customer.select(F.col("c_custkey").alias("customer_id"),
                                     F.col("c_mktsegment").alias("segment"), "c_nationkey")
            out = out.join(c, "customer_id")
        if "geo" in dims:
            geo = self.nation.join(self.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
                F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("prefecture"),
                F.col("r_name").alias("region"))
            out = out.join(geo, "c_nationkey")
        return out.drop("c_nationkey")

    def customers(self) -> DataFrame:
        return self.customer.select(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("segment"), "c_nationkey")

    def products(self) -> DataFrame:
        price = F.col("p_retailprice").cast(MONEY)
        return self.part.select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"), price.alias("list_price"),
            (price * F.lit(0.7).cast("decimal(2,1)")).cast(MONEY).alias("cost_price"),
            (F.col("p_size") > 5).alias("is_active"))

    def targets(self) -> DataFrame:
        """Monthly targets per region and category, for every year that has orders."""
        from lakeloom.operators.joins import cross_grid
        years = self.orders.select(F.year("o_orderdate").alias("target_year")).distinct()
        grid = cross_grid(
            years,
            {"target_month": list(range(1, 13))},
            {"region": self.region.select("r_name")},
            {"category": self.part.select("p_type").distinct()})
        return grid.withColumn(
            "target_amount", (F.lit(100000) * (F.col("target_month") + 12) / F.lit(12.0)).cast(MONEY))

    def crud(self) -> DataFrame:
        """Job x table usage flags, one row per (user, k) of the event log."""
        k = F.get_json_object("props", "$.k").cast("int")
        base = self.events.select("user_id", k.alias("k"), "event_type", "value")
        flags = [F.max((F.col("event_type") == ev).cast("int")).alias(c) for c, ev in FLAG_EVENTS.items()]
        g = base.groupBy("user_id", "k").agg(
            *flags, F.max((F.col("value") > 400).cast("int")).alias("file_i_flg"))
        job = F.concat(F.lit("JOB_"), F.lpad(F.col("user_id").cast("string"), 10, "0"))
        return g.select(
            job.alias("ajs_name"),
            F.concat(F.lit("NET_"), F.col("user_id") % 10).alias("net_name"),
            F.concat(job, F.lit(".sql")).alias("src_name"),
            F.concat(F.lit("T_"), F.col("k")).alias("table_name_jp"),
            F.concat(F.lit("FUNC_"), F.col("k") % 20).alias("function_name"),
            F.concat(F.lit("MOD_"), F.col("k") % 7).alias("module_name"),
            F.concat(F.lit("SYS_"), F.col("k") % 3).alias("system_name"),
            *FLAG_EVENTS, "file_i_flg")

    def src(self) -> DataFrame:
        """Program sources; only labelled documents carry a summary (their first line)."""
        d = self.documents.join(self.labels.select("doc_id", "quality"), "doc_id", "left")
        return d.select(
            F.col("doc_id").alias("source_id"),
            F.concat(F.col("doc_id").cast("string"), F.lit(".sql")).alias("file_name"),
            F.col("source").alias("module_name"), F.col("lang").alias("function_name"),
            F.concat(F.lit("JOB_"), F.lpad(F.col("doc_id").cast("string"), 10, "0")).alias("ajs_name"),
            F.when(F.col("quality").isNotNull(), F.expr(r"split_part(text, '\n', 1)")).alias("ai_summary"),
            F.col("text").alias("source_code"))

    def quality_log(self) -> DataFrame:
        v = F.col("value").cast(MONEY)
        return self.events.select(
            F.col("event_id").alias("log_id"), F.col("ts").alias("logged_at"),
            F.concat_ws(" ", "event_type", "props").alias("query"),
            (v * F.lit("0.002").cast("decimal(4,3)")).cast("decimal(18,5)").alias("max_similarity"),
            (v * 10).cast("decimal(18,1)").alias("latency_ms"),
            F.when(F.col("event_type") == "purchase", "good")
             .when(F.col("event_type") == "error", "bad").alias("user_feedback"))

    def eval_results(self) -> DataFrame:
        """Every labelled document is one case, answered once per tool type."""
        d = self.labels.join(self.documents.select("doc_id", "lang", "n_chars"), "doc_id")
        d = d.withColumn("tool_type", F.explode(F.array(F.lit("search_only"), F.lit("hybrid"))))
        hybrid = F.col("tool_type") == "hybrid"
        long_text = F.col("n_chars") > 500
        return d.select(
            F.col("doc_id").alias("test_case_id"), "tool_type",
            F.expr("substr('ABCDE', cast(doc_id % 5 as int) + 1, 1)").alias("category"),
            ((F.when(hybrid, long_text | (F.col("lang") == "en")).otherwise(long_text)).cast("int")
             == F.col("quality")).alias("is_correct"),
            F.expr("cast(least(10, doc_id % 11 + if(tool_type = 'hybrid', 2, 0)) * 0.1BD "
                   "as decimal(18,3))").alias("recall_score"),
            F.expr("cast(least(8, doc_id % 9 + if(tool_type = 'hybrid', 1, 0)) * 0.125BD "
                   "as decimal(18,3))").alias("precision_score"),
            F.expr("cast(1 + (n_chars + if(tool_type = 'hybrid', 1, 0)) % 5 as int)").alias("relevance_score"),
            F.expr("toxic = 0 or (tool_type = 'hybrid' and quality = 1)").alias("tool_match"),
            F.expr("cast(n_chars * if(tool_type = 'hybrid', 0.00125BD, 0.001BD) as decimal(18,5))")
             .alias("response_sec"))

    def doc_vectors(self) -> DataFrame:
        """Vector rows with the document they stand for."""
        return self.embeddings.join(self.documents, F.col("vec_id") == F.col("doc_id")).select(
            "vec_id", "embedding", "label", "lang", "source", "text",
            F.concat(F.lit("doc_"), F.col("vec_id").cast("string")).alias("doc_name"))

    def query_vectors(self) -> DataFrame:
        """One query per label: the vector with the lowest id of that label."""
        return self.embeddings.groupBy("label").agg(
            F.min("vec_id").alias("query_id"),
            F.min_by("embedding", "vec_id").alias("query_vec"))

    def manuals(self) -> DataFrame:
        """Documents filed under the product with the same key."""
        return self.documents.join(
            self.part.select("p_partkey", "p_name", "p_type"), F.col("doc_id") == F.col("p_partkey")
        ).select("doc_id", F.concat_ws("_", "p_name", "lang").alias("file_name"),
                 F.col("p_type").alias("category"), "text", "lang", "source")

    def changes(self) -> DataFrame:
        """Change log keyed by customer: the event log read as inserts, updates and deletes."""
        return self.events.select(
            F.col("user_id").alias("c_custkey"), F.col("event_id").alias("seq"),
            F.expr("CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END").alias("op"),
            F.col("value").alias("c_acctbal"))

    def principals(self) -> DataFrame:
        """User to department mapping; suppliers stand for users."""
        return self.supplier.select(
            F.col("s_name").alias("user_name"),
            F.concat(F.lit("src"), F.col("s_suppkey") % 20).alias("department"))


FRAME_SQL: dict[str, str] = {
    "sales": f"""
SELECT concat(l_orderkey, '-', l_linenumber) AS order_id, CAST(o_orderdate AS DATE) AS order_date,
  o_custkey AS customer_id, l_partkey AS product_id, p_name AS product_name, p_type AS category,
  CAST(l_quantity AS DECIMAL(18,0)) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS total_amount,
  r_name AS region, n_name AS prefecture, c_mktsegment AS segment, {STATUS_SQL} AS status,
  l_returnflag = 'R' AS returned
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""",
    "customers": "SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment, "
                 "c_nationkey FROM customer",
    "products": """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
  CAST(p_retailprice AS DECIMAL(18,2)) AS list_price,
  CAST(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(0.7 AS DECIMAL(2,1)) AS DECIMAL(18,2)) AS cost_price,
  p_size > 5 AS is_active FROM part""",
    "targets": """
SELECT y.target_year, m.target_month, r.r_name AS region, c.p_type AS category,
  CAST(100000 * (m.target_month + 12) / CAST(12.0 AS DOUBLE) AS DECIMAL(18,2)) AS target_amount
FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS target_year FROM orders) y
CROSS JOIN (SELECT CAST(range AS INT) AS target_month FROM range(1, 13)) m
CROSS JOIN region r CROSS JOIN (SELECT DISTINCT p_type FROM part) c""",
    "crud": """
SELECT 'JOB_' || lpad(CAST(user_id AS VARCHAR), 10, '0') AS ajs_name, 'NET_' || (user_id % 10) AS net_name,
  'JOB_' || lpad(CAST(user_id AS VARCHAR), 10, '0') || '.sql' AS src_name, 'T_' || k AS table_name_jp,
  'FUNC_' || (k % 20) AS function_name, 'MOD_' || (k % 7) AS module_name, 'SYS_' || (k % 3) AS system_name,
  CAST(max(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS INT) AS crud_c_flag,
  CAST(max(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS INT) AS crud_r_flag,
  CAST(max(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS INT) AS crud_u_flag,
  CAST(max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS INT) AS crud_d_flag,
  CAST(max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS INT) AS file_o_flg,
  CAST(max(CASE WHEN value > 400 THEN 1 ELSE 0 END) AS INT) AS file_i_flg
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events) GROUP BY user_id, k""",
    "src": r"""
SELECT d.doc_id AS source_id, d.doc_id || '.sql' AS file_name, d.source AS module_name,
  d.lang AS function_name, 'JOB_' || lpad(CAST(d.doc_id AS VARCHAR), 10, '0') AS ajs_name,
  CASE WHEN l.quality IS NOT NULL THEN split_part(d.text, chr(10), 1) END AS ai_summary,
  d.text AS source_code FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "quality_log": """
SELECT event_id AS log_id, ts AS logged_at, event_type || ' ' || props AS query,
  CAST(CAST(value AS DECIMAL(18,2)) * CAST(0.002 AS DECIMAL(4,3)) AS DECIMAL(18,5)) AS max_similarity,
  CAST(CAST(value AS DECIMAL(18,2)) * 10 AS DECIMAL(18,1)) AS latency_ms,
  CASE event_type WHEN 'purchase' THEN 'good' WHEN 'error' THEN 'bad' END AS user_feedback FROM events""",
    "eval_results": """
SELECT l.doc_id AS test_case_id, t.tool_type,
  substr('ABCDE', CAST(l.doc_id % 5 AS INT) + 1, 1) AS category,
  CAST(CASE WHEN t.tool_type = 'hybrid' THEN n_chars > 500 OR lang = 'en' ELSE n_chars > 500 END AS INT)
    = quality AS is_correct,
  CAST(least(10, l.doc_id % 11 + CASE WHEN t.tool_type = 'hybrid' THEN 2 ELSE 0 END)
    * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(18,3)) AS recall_score,
  CAST(least(8, l.doc_id % 9 + CASE WHEN t.tool_type = 'hybrid' THEN 1 ELSE 0 END)
    * CAST(0.125 AS DECIMAL(4,3)) AS DECIMAL(18,3)) AS precision_score,
  CAST(1 + (n_chars + CASE WHEN t.tool_type = 'hybrid' THEN 1 ELSE 0 END) % 5 AS INT) AS relevance_score,
  toxic = 0 OR (t.tool_type = 'hybrid' AND quality = 1) AS tool_match,
  CAST(n_chars * CASE WHEN t.tool_type = 'hybrid' THEN CAST(0.00125 AS DECIMAL(6,5))
    ELSE CAST(0.001 AS DECIMAL(6,5)) END AS DECIMAL(18,5)) AS response_sec
FROM labels l JOIN documents d ON l.doc_id = d.doc_id
CROSS JOIN (VALUES ('search_only'), ('hybrid')) t(tool_type)""",
    "doc_vectors": """
SELECT vec_id, CAST(embedding AS DOUBLE[]) AS embedding, label, lang, source, text,
  'doc_' || vec_id AS doc_name FROM embeddings JOIN documents ON vec_id = doc_id""",
    "vectors": "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS embedding, label FROM embeddings",
    "query_vectors": """
SELECT label, min(vec_id) AS query_id, CAST(arg_min(embedding, vec_id) AS DOUBLE[]) AS query_vec
FROM embeddings GROUP BY label""",
    "manuals": """
SELECT doc_id, p_name || '_' || lang AS file_name, p_type AS category, text, lang, source
FROM documents JOIN part ON doc_id = p_partkey""",
    "changes": """
SELECT user_id AS c_custkey, event_id AS seq,
  CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op, value AS c_acctbal
FROM events""",
    "principals": "SELECT s_name AS user_name, 'src' || (s_suppkey % 20) AS department FROM supplier",
}
