"""Declared sales and job-usage models, their measures and the metric queries over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions import dates
from lakeloom.functions.numbers import count_if, dbl, pct, sum_if
from lakeloom.operators.semantic import Measure, Model, Relationship, metric_query, metrics_across, resolve_terms
from lakeloom.operators.semantic import infer_model
from lakeloom.plans.frames import Frames
from lakeloom.plans.registry import query

LIVE = "status <> 'cancelled'"

SALES = Model(
    name="sales",
    measures={m.name: m for m in (
        Measure("total_sales", f"CAST(sum(if({LIVE}, total_amount, 0)) AS DOUBLE)"),
        Measure("order_count", f"count(if({LIVE}, order_id, NULL))"),
        Measure("avg_order_value", f"round(CAST(sum(if({LIVE}, total_amount, NULL)) AS DOUBLE)"
                                   f" / nullif(count(if({LIVE}, total_amount, NULL)), 0), 4)"),
        Measure("cancelled_count", "count(if(status = 'cancelled', order_id, NULL))"),
        Measure("cancelled_rate", "round(count(if(status = 'cancelled', order_id, NULL)) * 100D"
                                  " / nullif(count(order_id), 0), 1)"),
        Measure("cancelled_rate_2", "round(count(if(status = 'cancelled', order_id, NULL)) * 100D"
                                    " / nullif(count(order_id), 0), 2)"),
        Measure("total_quantity", f"CAST(sum(if({LIVE}, quantity, 0)) AS BIGINT)"),
        Measure("net_sales", f"CAST(sum(if({LIVE} AND NOT returned, total_amount, 0)) AS DOUBLE)"),
        Measure("gross_amount", "total_amount", "sum"),
        Measure("line_count", "order_id", "count"),
        Measure("buyer_count", "customer_id", "count_distinct"),
        Measure("max_amount", "total_amount", "max"),
        Measure("live_sales", "CAST(sum(live_amount) AS DOUBLE)"),
        Measure("live_share_pct", "round(CAST(sum(live_amount) AS DOUBLE) * 100"
                                  " / nullif(CAST(sum(total_amount) AS DOUBLE), 0), 1)"),
    )},
    dimensions={"status": "status", "category": "category", "region": "region"},
    time_dimensions=("order_date",),
    relationships=(
        Relationship("products", ("product_id",), ("product_name", "category", "cost_price")),
        Relationship("customers", ("customer_id",), ("segment", "c_nationkey")),
        Relationship("customer_geo", ("customer_id",), ("prefecture", "region")),
    ),
)

SALES_FACTS = Model(
    name="sales", measures=SALES.measures, time_dimensions=("order_date",),
    relationships=SALES.relationships,
    facts={"live_amount": f"if({LIVE}, total_amount, 0)"})

PRODUCTS = Model(
    name="products",
    measures={m.name: m for m in (
        Measure("product_count", "count(if(is_active, product_id, NULL))"),
        Measure("avg_list_price", "round(CAST(sum(list_price) AS DOUBLE) / count(list_price), 4)"),
        Measure("avg_margin_rate", "round(CAST(sum(CAST((list_price - cost_price) * 100"
                                   " / nullif(list_price, 0) AS DECIMAL(18,6))) AS DOUBLE)"
                                   " / count(nullif(list_price, 0)), 1)"),
    )},
    dimensions={"category": "category"})

TARGETS = Model("targets", {"total_target": Measure("total_target", "CAST(sum(target_amount) AS DOUBLE)")})

CRUD = Model(
    name="crud",
    measures={m.name: m for m in (
        Measure("job_count", "count(DISTINCT ajs_name)"),
        Measure("table_count", "count(DISTINCT table_name_jp)"),
        Measure("program_count", "count(DISTINCT src_name)"),
    )})


def provider(f: Frames):
    """Tables of the models by name."""
    def table(name: str):
        if name == "customer_geo":
            return f.customers().join(
                f.nation.join(f.region, F.col("n_regionkey") == F.col("r_regionkey")),
                F.col("c_nationkey") == F.col("n_nationkey")
            ).select("customer_id", F.col("n_name").alias("prefecture"), F.col("r_name").alias("region"))
        return getattr(f, name)()
    return table


def sales_metrics(f: Frames, measures, dims=(), grain=None, filters=(), model=SALES):
    return metric_query(model, provider(f), list(measures), list(dims), grain, list(filters))


MONTH = "CAST(date_trunc('month', order_date) AS DATE)"
LIVE_SUM = "CAST(sum(CASE WHEN status <> 'cancelled' THEN total_amount ELSE 0 END) AS DOUBLE)"
LIVE_COUNT = "count(CASE WHEN status <> 'cancelled' THEN order_id END)"


@query("metric_query", f"""
SELECT {MONTH} AS month, segment, {LIVE_SUM} AS total_sales, {LIVE_COUNT} AS order_count,
  CAST(sum(CASE WHEN status <> 'cancelled' THEN quantity ELSE 0 END) AS BIGINT) AS total_quantity
FROM sales WHERE order_date >= DATE '2000-01-01' GROUP BY 1, 2""", "sales")
def _metric_query(f):
    return sales_metrics(f, ["total_sales", "order_count", "total_quantity"], ["segment"],
                         ("order_date", "month"), ["order_date >= DATE '2000-01-01'"])


def by_category(measure: str, sql: str) -> None:
    query(f"m_{measure}", f"SELECT category, {sql} AS {measure} FROM sales GROUP BY category", "sales")(
        lambda f: sales_metrics(f, [measure], ["category"]))


by_category("total_sales", LIVE_SUM)
by_category("order_count", LIVE_COUNT)
by_category("avg_order_value",
            "round(CAST(sum(CASE WHEN status <> 'cancelled' THEN total_amount END) AS DOUBLE)"
            " / count(CASE WHEN status <> 'cancelled' THEN total_amount END), 4)")
by_category("cancelled_count", "count(CASE WHEN status = 'cancelled' THEN order_id END)")
by_category("total_quantity", "CAST(sum(CASE WHEN status <> 'cancelled' THEN quantity ELSE 0 END) AS BIGINT)")
by_category("net_sales", "CAST(sum(CASE WHEN status <> 'cancelled' AND NOT returned THEN total_amount"
                         " ELSE 0 END) AS DOUBLE)")


@query("m_cancelled_rate", """
SELECT category,
  round(count(CASE WHEN status = 'cancelled' THEN order_id END) * 100.0::DOUBLE / nullif(count(order_id), 0), 1)
    AS cancelled_rate,
  round(count(CASE WHEN status = 'cancelled' THEN order_id END) * 100.0::DOUBLE / nullif(count(order_id), 0), 2)
    AS cancelled_rate_2
FROM sales GROUP BY category""", "sales")
def _cancelled_rate(f):
    return sales_metrics(f, ["cancelled_rate", "cancelled_rate_2"], ["category"])


@query("m_product_count", "SELECT category, count(CASE WHEN is_active THEN product_id END) AS product_count "
                          "FROM products GROUP BY category", "products")
def _product_count(f):
    return sales_metrics(f, ["product_count"], ["category"], model=PRODUCTS)


@query("m_avg_list_price", "SELECT category, round(CAST(sum(list_price) AS DOUBLE) / count(list_price), 4) "
                           "AS avg_list_price FROM products GROUP BY category", "products")
def _avg_list_price(f):
    return sales_metrics(f, ["avg_list_price"], ["category"], model=PRODUCTS)


@query("m_avg_margin_rate", """
SELECT category, round(avg((CAST(list_price AS DOUBLE) - CAST(cost_price AS DOUBLE)) * 100
  / nullif(CAST(list_price AS DOUBLE), 0)), 1) AS avg_margin_rate FROM products GROUP BY category""", "products")
def _avg_margin_rate(f):
    return sales_metrics(f, ["avg_margin_rate"], ["category"], model=PRODUCTS)


@query("m_total_target", "SELECT region, CAST(sum(target_amount) AS DOUBLE) AS total_target FROM targets "
                         "GROUP BY region", "targets")
def _total_target(f):
    return sales_metrics(f, ["total_target"], ["region"], model=TARGETS)


def first_order_sales(sales, order_key: str | None = None):
    """Sales of each customer's first order.

    As declared: the first order is the smallest order id. The other form takes the order id of
    the earliest date. Both are one aggregation per customer; ``max_by`` style structs combine
    map-side.
    """
    live = sales.where(LIVE)
    first = F.min("order_id") if order_key is None else F.min(F.struct(order_key, "order_id"))["order_id"]
    firsts = live.groupBy("customer_id").agg(first.alias("order_id"))
    return live.join(firsts, ["customer_id", "order_id"], "left_semi")


@query("m_new_customer_sales", """
WITH live AS (SELECT * FROM sales WHERE status <> 'cancelled'),
a AS (SELECT customer_id, min(order_id) AS order_id FROM live GROUP BY customer_id),
b AS (SELECT customer_id, order_id FROM (SELECT customer_id, order_id, row_number() OVER (
  PARTITION BY customer_id ORDER BY order_date, order_id) AS rn FROM live) WHERE rn = 1)
SELECT 'smallest_id' AS definition, CAST(sum(total_amount) AS DOUBLE) AS new_customer_sales
FROM live SEMI JOIN a USING (customer_id, order_id)
UNION ALL
SELECT 'earliest_date', CAST(sum(total_amount) AS DOUBLE) FROM live SEMI JOIN b USING (customer_id, order_id)
""", "sales")
def _new_customer_sales(f):
    s = f.sales()
    total = F.sum("total_amount").cast("double").alias("new_customer_sales")
    a = first_order_sales(s).agg(total).select(F.lit("smallest_id").alias("definition"), "*")
    b = first_order_sales(s, "order_date").agg(total).select(F.lit("earliest_date").alias("definition"), "*")
    return a.unionByName(b)


@query("m_ytd_sales", """
SELECT segment, CAST(sum(CASE WHEN year(order_date) = 2001 AND status <> 'cancelled' THEN total_amount
  ELSE 0 END) AS DOUBLE) AS ytd_sales FROM sales GROUP BY segment""", "sales")
def _ytd_sales(f):
    cond = dates.in_year("order_date", f.as_of) & F.expr(LIVE)
    return f.sales("customer").groupBy("segment").agg(
        sum_if(cond, "total_amount").cast("double").alias("ytd_sales"))


@query("m_gross_margin_rate", """
SELECT s.category, round(CAST(sum(CASE WHEN status <> 'cancelled' THEN total_amount - cost_price * quantity
  ELSE 0 END) AS DOUBLE) * 100.0::DOUBLE / nullif(CAST(sum(CASE WHEN status <> 'cancelled' THEN total_amount ELSE 0 END)
  AS DOUBLE), 0), 2) AS gross_margin_rate
FROM sales s LEFT JOIN (SELECT product_id, cost_price FROM products) p ON s.product_id = p.product_id
GROUP BY s.category""", "sales products")
def _gross_margin_rate(f):
    s = f.sales().join(f.products().select("product_id", "category", "cost_price"), "product_id", "left")
    live = F.expr(LIVE)
    sales = F.sum(F.when(live, F.col("total_amount")).otherwise(0))
    margin = F.sum(F.when(live, F.col("total_amount") - F.col("cost_price") * F.col("quantity")).otherwise(0))
    return s.groupBy("category").agg(pct(margin, sales, 2).alias("gross_margin_rate"))


@query("m_default_aggregation", """
SELECT status, CAST(sum(total_amount) AS DOUBLE) AS gross_amount, count(order_id) AS line_count,
  count(DISTINCT customer_id) AS buyer_count, CAST(max(total_amount) AS DOUBLE) AS max_amount
FROM sales GROUP BY status""", "sales")
def _default_aggregation(f):
    df = sales_metrics(f, ["gross_amount", "line_count", "buyer_count", "max_amount"], ["status"])
    return df.withColumn("gross_amount", dbl("gross_amount")).withColumn("max_amount", dbl("max_amount"))


@query("m_facts_metrics", f"""
SELECT category, {LIVE_SUM} AS live_sales, round({LIVE_SUM} * 100
  / nullif(CAST(sum(total_amount) AS DOUBLE), 0), 1) AS live_share_pct FROM sales GROUP BY category""", "sales")
def _facts_metrics(f):
    return sales_metrics(f, ["live_sales", "live_share_pct"], ["category"], model=SALES_FACTS)


@query("m_crud_counts", """
SELECT system_name, count(DISTINCT ajs_name) AS job_count, count(DISTINCT table_name_jp) AS table_count,
  count(DISTINCT src_name) AS program_count FROM crud GROUP BY system_name""", "crud")
def _crud_counts(f):
    return sales_metrics(f, ["job_count", "table_count", "program_count"], ["system_name"], model=CRUD)


@query("time_grain", """
SELECT 'order' AS date_column, g.grain, CAST(date_trunc(g.grain, o_orderdate) AS DATE) AS period, count(*) AS n
FROM orders CROSS JOIN (VALUES ('day'), ('week'), ('month'), ('year')) g(grain) GROUP BY 2, 3
UNION ALL
SELECT 'ship', 'month', CAST(date_trunc('month', l_shipdate) AS DATE), count(*) FROM lineitem GROUP BY 3""")
def _time_grain(f):
    # one scan: counted per day first, the coarser grains are rolled up from the days
    def days(df, col, name):
        return df.groupBy(F.to_date(col).alias("d")).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("date_column"), "d", "n")
    order = days(f.orders, "o_orderdate", "order")
    grains = order.select("date_column", "n", F.explode(F.array(*[
        F.struct(F.lit(g).alias("grain"), dates.grain_of("d", g).alias("period"))
        for g in ("day", "week", "month", "year")])).alias("g")).select("date_column", "n", "g.*")
    ship = days(f.lineitem, "l_shipdate", "ship").select(
        "date_column", "n", F.lit("month").alias("grain"), dates.grain_of("d", "month").alias("period"))
    return grains.unionByName(ship).groupBy("date_column", "grain", "period").agg(F.sum("n").alias("n"))


# Usage words and the filter each one stands for.
USAGE_SYNONYMS = [
    ("使用している", "crud_r_flag=1 OR crud_c_flag=1 OR crud_u_flag=1 OR crud_d_flag=1"),
    ("参照している", "crud_r_flag=1 OR crud_c_flag=1 OR crud_u_flag=1 OR crud_d_flag=1"),
    ("更新している", "crud_u_flag = 1"),
    ("修正している", "crud_u_flag = 1"),
    ("削除している", "crud_d_flag = 1"),
    ("作成している", "crud_c_flag = 1"),
    ("INSERTしている", "crud_c_flag = 1"),
    ("読んでいる", "crud_r_flag = 1"),
    ("SELECTしている", "crud_r_flag = 1"),
    ("ファイルを出している", "file_o_flg = 1"),
    ("ファイルを取り込んでいる", "file_i_flg = 1"),
]
CORPUS_SYNONYMS = [("view", "crud_r_flag = 1"), ("click", "crud_u_flag = 1"), ("error", "crud_d_flag = 1"),
                   ("signup", "crud_c_flag = 1"), ("purchase", "file_o_flg = 1")]


@query("synonym_resolve", """
SELECT log_id, t.term, t.target FROM quality_log JOIN (VALUES
  ('view', 'crud_r_flag = 1'), ('click', 'crud_u_flag = 1'), ('error', 'crud_d_flag = 1'),
  ('signup', 'crud_c_flag = 1'), ('purchase', 'file_o_flg = 1')) t(term, target)
ON contains(' ' || regexp_replace(lower(query), '[^\\p{L}\\p{N}]+', ' ', 'g') || ' ', ' ' || t.term || ' ')""", "quality_log")
def _synonym_resolve(f):
    terms = f.spark.createDataFrame(USAGE_SYNONYMS + CORPUS_SYNONYMS, "term string, target string")
    return resolve_terms(f.quality_log(), "query", "log_id", terms)


@query("metrics_across_facts", f"""SELECT coalesce(a.category, b.category) AS category, total_sales, order_count, product_count, avg_list_price FROM (
SELECT category, {LIVE_SUM} AS total_sales, {LIVE_COUNT} AS order_count FROM sales GROUP BY 1) a FULL JOIN (
SELECT category, count(CASE WHEN is_active THEN product_id END) AS product_count,
  round(CAST(sum(list_price) AS DOUBLE) / count(list_price), 4) AS avg_list_price FROM products GROUP BY 1) b ON a.category = b.category""", "sales products")
def _across(f):
    """Measures of orders and of products by the category that both have."""
    return metrics_across([(SALES, ["total_sales", "order_count"]), (PRODUCTS, ["product_count", "avg_list_price"])], provider(f), ["category"])


@query("infer_model")
def _infer_model(f):
    return infer_model(f.orders, "orders").unionByName(infer_model(f.lineitem, "lineitem"))
