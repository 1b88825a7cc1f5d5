"""The user-callable jobs over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom import api
from lakeloom.functions import dates
from lakeloom.plans.registry import query
from lakeloom.plans.sales_model import LIVE_COUNT, LIVE_SUM, sales_metrics
from lakeloom.sources.tables import register_views


@query("rag_search")
def _rag(f):
    """Every benchmark question against the hashed vectors of whole documents."""
    docs = f.texts.select(F.col("doc_id").alias("chunk_no"), F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("doc_name"),
                              F.col("text").alias("chunk_text"))
    vec = api.default_encoder(docs, ["chunk_no", "doc_name", "chunk_text"], "chunk_text")
    q = f.benchmark.select(F.col("item_id").alias("question_id"), F.col("text").alias("question"))
    return api.rag_search(vec, q, 3, 0.3)


@query("search_with_sources")
def _search(f):
    docs = f.texts.select("doc_id", F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("doc_name"),
                              F.col("source").alias("department"), "text")
    q = f.benchmark.select(F.col("item_id").alias("question_id"), F.col("text").alias("question"))
    return api.search_with_sources(docs, q, "src3", 3)


NAMED = {
    "this_year": lambda f: sales_metrics(f, ["total_sales", "order_count"], filters=[dates.in_year("order_date", f.as_of)]),
    "this_month": lambda f: sales_metrics(f, ["total_sales", "order_count"], filters=[dates.in_month("order_date", f.as_of)]),
    "future": lambda f: sales_metrics(f, ["total_sales", "order_count"], ["status"], filters=[dates.in_year("order_date", f.as_of, 5)]),
}


@query("run_named_query", f"""WITH y AS (SELECT {LIVE_SUM} AS s, {LIVE_COUNT} AS c FROM sales WHERE order_date >= DATE '2001-01-01' AND order_date < DATE '2002-01-01'),
m AS (SELECT {LIVE_SUM} AS s, {LIVE_COUNT} AS c FROM sales WHERE order_date >= DATE '2001-07-01' AND order_date < DATE '2001-08-01')
SELECT 'this_year' AS name, s AS total_sales, c AS order_count, NULL AS message FROM y UNION ALL SELECT 'this_month', s, c, NULL FROM m
UNION ALL SELECT 'future', NULL, NULL, 'no rows'""", "sales")
def _named(f):
    r = api.run_named(f.spark, list(NAMED), {n: (lambda fn=fn: fn(f)) for n, fn in NAMED.items()})
    j = F.from_json("result", "total_sales double, order_count bigint")
    return r.select("name", j["total_sales"].alias("total_sales"), j["order_count"].alias("order_count"),
                    F.when(F.col("result") == api.NO_DATA, F.col("result")).alias("message"))


@query("catalog_describe")
def _describe(f):
    names = ["orders", "lineitem", "documents", "events"]
    register_views(f.spark, f.folder, names)
    return api.describe_tables(f.spark, names)
