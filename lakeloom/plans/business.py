"""Verified sales questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions import dates
from lakeloom.functions.numbers import count_if, dbl, pct, sum_if
from lakeloom.operators.aggregates import change_pct, period_columns, with_share
from lakeloom.operators.topk import top
from lakeloom.plans.registry import query
from lakeloom.plans.sales_model import LIVE, LIVE_COUNT, LIVE_SUM, MONTH, sales_metrics

PREV = "order_date >= DATE '2001-06-01' AND order_date < DATE '2001-07-01'"
THIS = "order_date >= DATE '2001-07-01' AND order_date < DATE '2001-08-01'"
YEAR = "order_date >= DATE '2001-01-01' AND order_date < DATE '2002-01-01'"


def not_cancelled():
    return F.col("status") != "cancelled"


def sales_sum():
    return F.sum("total_amount").cast("double").alias("total_sales")


def sales_count():
    return F.count("order_id").alias("order_count")


@query("monthly_sales_trend", f"SELECT {MONTH} AS month, {LIVE_SUM} AS total_sales, {LIVE_COUNT} AS order_count "
                              "FROM sales GROUP BY 1", "sales")
def _monthly(f):
    return sales_metrics(f, ["total_sales", "order_count"], grain=("order_date", "month")).orderBy("month")


@query("monthly_trend_filtered", f"SELECT {MONTH} AS month, CAST(sum(total_amount) AS DOUBLE) AS total_sales, "
       "count(order_id) AS order_count FROM sales WHERE status <> 'cancelled' GROUP BY 1", "sales")
def _monthly_filtered(f):
    return f.sales().where(not_cancelled()).groupBy(dates.month_of("order_date").alias("month")).agg(
        sales_sum(), sales_count()).orderBy("month")


def top_products(f, k: int, offset: int = -1):
    s = f.sales("product").where(not_cancelled() & dates.in_month("order_date", f.as_of, offset))
    g = s.groupBy("product_name").agg(sales_sum(), sales_count())
    return top(g, [F.col("total_sales").desc(), F.col("product_name")], k)


@query("top5_products_last_month", f"""
SELECT product_name, CAST(sum(total_amount) AS DOUBLE) AS total_sales, count(order_id) AS order_count
FROM sales WHERE status <> 'cancelled' AND {PREV} GROUP BY product_name
ORDER BY total_sales DESC, product_name LIMIT 5""", "sales")
def _top5(f):
    return top_products(f, 5)


@query("sales_by_category", f"""
SELECT category, {LIVE_SUM} AS total_sales,
  round({LIVE_SUM} * 100.0::DOUBLE / sum({LIVE_SUM}) OVER (), 1) AS sales_ratio_pct
FROM sales GROUP BY category""", "sales")
def _by_category(f):
    return with_share(sales_metrics(f, ["total_sales"], ["category"]), "total_sales", "sales_ratio_pct")


@query("sales_by_segment", f"""
SELECT segment, {LIVE_SUM} AS total_sales, {LIVE_COUNT} AS order_count,
  round(CAST(sum(CASE WHEN status <> 'cancelled' THEN total_amount END) AS DOUBLE)
    / count(CASE WHEN status <> 'cancelled' THEN total_amount END), 4) AS avg_order_value,
  round({LIVE_SUM} * 100.0::DOUBLE / sum({LIVE_SUM}) OVER (), 1) AS sales_ratio_pct
FROM sales GROUP BY segment""", "sales")
def _by_segment(f):
    g = sales_metrics(f, ["total_sales", "order_count", "avg_order_value"], ["segment"])
    return with_share(g, "total_sales", "sales_ratio_pct")


@query("region_monthly_sales", f"""
SELECT {MONTH} AS month, region, {LIVE_SUM} AS total_sales, {LIVE_COUNT} AS order_count
FROM sales GROUP BY 1, 2""", "sales")
def _region_monthly(f):
    return sales_metrics(f, ["total_sales", "order_count"], ["region"], ("order_date", "month"))


@query("this_year_sales", f"SELECT {LIVE_SUM} AS total_sales, {LIVE_COUNT} AS order_count FROM sales WHERE {YEAR}",
       "sales")
def _this_year(f):
    return sales_metrics(f, ["total_sales", "order_count"], filters=[dates.in_year("order_date", f.as_of)])


@query("top_customers_ytd", f"""
SELECT s.customer_id, c.customer_name, CAST(sum(total_amount) AS DOUBLE) AS total_sales,
  count(order_id) AS order_count
FROM sales s JOIN customers c ON s.customer_id = c.customer_id WHERE status <> 'cancelled' AND {YEAR}
GROUP BY 1, 2 ORDER BY total_sales DESC, s.customer_id LIMIT 10""", "sales customers")
def _top_customers(f):
    # rank ids first, look the ten names up afterwards
    g = f.sales().where(not_cancelled() & dates.in_year("order_date", f.as_of)).groupBy("customer_id").agg(
        sales_sum(), sales_count())
    best = top(g, [F.col("total_sales").desc(), F.col("customer_id")], 10)
    return best.join(f.customers().select("customer_id", "customer_name"), "customer_id")


@query("cancel_rate_by_category", """
SELECT category, count(order_id) AS total_orders,
  count(CASE WHEN status = 'cancelled' THEN order_id END) AS cancelled_orders,
  round(count(CASE WHEN status = 'cancelled' THEN order_id END) * 100.0::DOUBLE / nullif(count(order_id), 0), 1)
    AS cancelled_rate_pct FROM sales GROUP BY category""", "sales")
def _cancel_rate(f):
    n, c = F.count("order_id"), count_if(F.col("status") == "cancelled", "order_id")
    return f.sales("product").groupBy("category").agg(
        n.alias("total_orders"), c.alias("cancelled_orders"), pct(c, n).alias("cancelled_rate_pct"))


@query("yoy_same_month", f"""
SELECT CAST(year(order_date) AS INT) AS year, CAST(month(order_date) AS INT) AS month, {LIVE_SUM} AS total_sales
FROM sales WHERE month(order_date) = 7 AND year(order_date) IN (2000, 2001) GROUP BY 1, 2""", "sales")
def _yoy(f):
    s = f.sales().where(dates.in_month_or_year_ago("order_date", f.as_of))
    return s.groupBy(F.year("order_date").alias("year"), F.month("order_date").alias("month")).agg(
        sum_if(not_cancelled(), "total_amount").cast("double").alias("total_sales"))


COST_SUM = "CAST(sum(CASE WHEN status <> 'cancelled' THEN cost_price * quantity ELSE 0 END) AS DOUBLE)"


@query("gross_margin_by_product", f"""
SELECT o.product_name, o.category, {LIVE_SUM} AS total_sales, {COST_SUM} AS total_cost,
  round(({LIVE_SUM} - {COST_SUM}) * 100.0::DOUBLE / nullif({LIVE_SUM}, 0), 1) AS gross_margin_pct
FROM sales o LEFT JOIN (SELECT product_id, cost_price FROM products) p ON o.product_id = p.product_id
GROUP BY o.product_name, o.category""", "sales products")
def _gross_margin(f):
    s = f.sales().join(f.products().select("product_id", "product_name", "category", "cost_price"),
                       "product_id", "left")
    g = s.groupBy("product_name", "category").agg(
        sum_if(not_cancelled(), "total_amount").cast("double").alias("total_sales"),
        sum_if(not_cancelled(), F.col("cost_price") * F.col("quantity")).cast("double").alias("total_cost"))
    return g.withColumn("gross_margin_pct", pct(F.col("total_sales") - F.col("total_cost"), F.col("total_sales")))


def actual_by_target_key(sales):
    """Sales on the four target keys; aggregated before the join, so targets never multiply rows."""
    return sales.groupBy("region", "category", F.year("order_date").alias("target_year"),
                         F.month("order_date").alias("target_month")).agg(
        sum_if(not_cancelled(), "total_amount").alias("actual"))


@query("target_achievement", """
SELECT t.region, t.category, CAST(t.target_amount AS DOUBLE) AS target_amount,
  CAST(coalesce(sum(CASE WHEN o.status <> 'cancelled' THEN o.total_amount ELSE 0 END), 0) AS DOUBLE) AS actual_sales,
  round(CAST(coalesce(sum(CASE WHEN o.status <> 'cancelled' THEN o.total_amount ELSE 0 END), 0) AS DOUBLE) * 100.0::DOUBLE
    / nullif(CAST(t.target_amount AS DOUBLE), 0), 1) AS achievement_rate_pct
FROM targets t LEFT JOIN sales o ON t.region = o.region AND t.category = o.category
  AND t.target_year = year(o.order_date) AND t.target_month = month(o.order_date)
WHERE t.target_year = 2001 AND t.target_month = 7 GROUP BY t.region, t.category, t.target_amount""",
       "sales targets")
def _target(f):
    t = f.targets().where((F.col("target_year") == f.as_of.year) & (F.col("target_month") == f.as_of.month))
    actual = actual_by_target_key(
        f.sales("product", "geo").where(dates.in_month("order_date", f.as_of)))
    j = t.join(actual, ["region", "category", "target_year", "target_month"], "left")
    done = F.coalesce(F.col("actual"), F.lit(0).cast("decimal(28,2)"))
    return j.select("region", "category", dbl("target_amount").alias("target_amount"),
                    done.cast("double").alias("actual_sales"),
                    pct(done, F.col("target_amount")).alias("achievement_rate_pct"))


@query("sales_by_location", f"SELECT prefecture, {LIVE_SUM} AS total_sales, {LIVE_COUNT} AS order_count "
                            "FROM sales GROUP BY prefecture", "sales")
def _by_location(f):
    return sales_metrics(f, ["total_sales", "order_count"], ["prefecture"]).orderBy(
        F.col("total_sales").desc(), "prefecture")


@query("region_category_matrix", f"""
SELECT region, category, {LIVE_SUM} AS total_sales, {LIVE_COUNT} AS order_count
FROM sales GROUP BY region, category""", "sales")
def _matrix(f):
    return sales_metrics(f, ["total_sales", "order_count"], ["region", "category"]).orderBy(
        "region", F.col("total_sales").desc(), "category")


@query("this_month_total", f"SELECT {LIVE_SUM} AS total_sales, {LIVE_COUNT} AS order_count FROM sales WHERE {THIS}",
       "sales")
def _this_month(f):
    return sales_metrics(f, ["total_sales", "order_count"], filters=[dates.in_month("order_date", f.as_of)])


@query("last_month_total", f"SELECT CAST(sum(total_amount) AS DOUBLE) AS total_sales FROM sales "
                           f"WHERE status <> 'cancelled' AND {PREV}", "sales")
def _last_month(f):
    return f.sales().where(not_cancelled() & dates.in_month("order_date", f.as_of, -1)).agg(sales_sum())


@query("category_ranking", f"""
SELECT category, {LIVE_SUM} AS total_sales FROM sales GROUP BY category
ORDER BY total_sales DESC, category LIMIT 5""", "sales")
def _category_ranking(f):
    return top(sales_metrics(f, ["total_sales"], ["category"]),
               [F.col("total_sales").desc(), F.col("category")], 5)


@query("segment_avg_order_value", """
SELECT round(CAST(sum(total_amount) AS DOUBLE) / count(*), 4) AS avg_order_value FROM sales
WHERE status <> 'cancelled' AND segment = 'MACHINERY'""", "sales")
def _segment_avg(f):
    return sales_metrics(f, ["avg_order_value"], filters=["segment = 'MACHINERY'"])


@query("return_rate_by_product", """
SELECT product_name, count(*) AS lines, count(CASE WHEN returned THEN 1 END) AS returned_lines,
  round(count(CASE WHEN returned THEN 1 END) * 100.0::DOUBLE / count(*), 2) AS return_rate_pct
FROM sales GROUP BY product_name ORDER BY return_rate_pct DESC, product_name LIMIT 1""", "sales")
def _return_rate(f):
    n, r = F.count(F.lit(1)), count_if(F.col("returned"))
    g = f.sales("product").groupBy("product_name").agg(
        n.alias("lines"), r.alias("returned_lines"), pct(r, n, 2).alias("return_rate_pct"))
    return top(g, [F.col("return_rate_pct").desc(), F.col("product_name")], 1)


def first_order_month(f):
    """Registration month: the month of a customer's first order."""
    return f.orders.groupBy("o_custkey").agg(F.min(F.to_date("o_orderdate")).alias("registered_date"))


FIRSTS = "(SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS registered_date FROM orders GROUP BY 1)"


@query("new_customers_last_month", f"SELECT count(*) AS new_customers FROM {FIRSTS} WHERE "
                                   "registered_date >= DATE '1995-02-01' AND registered_date < DATE '1995-03-01'")
def _new_customers(f):
    import datetime as dt
    # the driver's customers all start early: the business date of this question is March 1995
    reg = first_order_month(f).where(dates.in_month("registered_date", dt.date(1995, 3, 15), -1))
    return reg.agg(F.count(F.lit(1)).alias("new_customers"))


@query("new_customers_by_month", f"SELECT CAST(date_trunc('month', registered_date) AS DATE) AS month, "
                                 f"count(*) AS new_customers FROM {FIRSTS} GROUP BY 1")
def _new_by_month(f):
    return first_order_month(f).groupBy(dates.month_of("registered_date").alias("month")).agg(
        F.count(F.lit(1)).alias("new_customers"))


PERIODS = (f"CAST(sum(CASE WHEN {THIS} AND status <> 'cancelled' THEN total_amount ELSE 0 END) AS DOUBLE) AS this_month, "
           f"CAST(sum(CASE WHEN {PREV} AND status <> 'cancelled' THEN total_amount ELSE 0 END) AS DOUBLE) AS last_month")
CHANGE = "round((this_month - last_month) * 100.0::DOUBLE / nullif(last_month, 0), 1)"


def month_pair(f, keys, sales):
    """This and last month side by side; the date range of both is pushed to the scan."""
    this, prev = dates.in_month("order_date", f.as_of), dates.in_month("order_date", f.as_of, -1)
    s = sales.where(not_cancelled() & (this | prev))
    return change_pct(period_columns(s, keys, F.col("total_amount"), {"this_month": this, "last_month": prev}),
                      "this_month", "last_month")


@query("mom_change", f"""
SELECT category, this_month, last_month, {CHANGE} AS change_pct, {CHANGE} <= -10.0 AS alert
FROM (SELECT category, {PERIODS} FROM sales GROUP BY category)""", "sales")
def _mom(f):
    g = month_pair(f, ["category"], f.sales("product"))
    return g.withColumn("alert", F.col("change_pct") <= -10.0).orderBy("change_pct", "category")


@query("worst_category", f"""
SELECT category, this_month, last_month, {CHANGE} AS change_pct
FROM (SELECT category, {PERIODS} FROM sales GROUP BY category) ORDER BY change_pct, category LIMIT 1""", "sales")
def _worst(f):
    return top(month_pair(f, ["category"], f.sales("product")), [F.col("change_pct"), F.col("category")], 1)


@query("period_growth", f"SELECT this_month, last_month, {CHANGE} AS change_pct FROM (SELECT {PERIODS} FROM sales)",
       "sales")
def _growth(f):
    return month_pair(f, [], f.sales())


@query("period_pivot", f"SELECT segment, this_month, last_month FROM (SELECT segment, {PERIODS} FROM sales "
                       "GROUP BY segment)", "sales")
def _pivot(f):
    return month_pair(f, ["segment"], f.sales("customer")).drop("change_pct")


@query("region_compare_ytd", f"""
SELECT {MONTH} AS month,
  CAST(sum(CASE WHEN region = 'ASIA' AND status <> 'cancelled' THEN total_amount ELSE 0 END) AS DOUBLE) AS asia_sales,
  CAST(sum(CASE WHEN region = 'EUROPE' AND status <> 'cancelled' THEN total_amount ELSE 0 END) AS DOUBLE) AS europe_sales
FROM sales WHERE region IN ('ASIA', 'EUROPE') AND {YEAR} GROUP BY 1""", "sales")
def _region_compare(f):
    s = f.sales("geo").where(F.col("region").isin("ASIA", "EUROPE") & dates.in_year("order_date", f.as_of))
    return s.groupBy(dates.month_of("order_date").alias("month")).agg(*[
        sum_if(not_cancelled() & (F.col("region") == r), "total_amount").cast("double").alias(n)
        for r, n in (("ASIA", "asia_sales"), ("EUROPE", "europe_sales"))])


@query("segment_ytd_total", f"SELECT {LIVE_SUM} AS total_sales FROM sales WHERE segment = 'BUILDING' AND {YEAR}", "sales")
def _segment_ytd(f):
    return sales_metrics(f, ["total_sales"], filters=["segment = 'BUILDING'", dates.in_year("order_date", f.as_of)])


@query("person_month_summary", """
SELECT c_custkey AS employee_id, c_name AS emp_name, count(*) AS applications,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount, max(o_orderstatus) AS latest_status
FROM customer JOIN orders ON c_custkey = o_custkey
WHERE c_name LIKE '%00007%' AND o_orderdate >= TIMESTAMP '2001-07-01' AND o_orderdate < TIMESTAMP '2001-08-01'
GROUP BY 1, 2""")
def _person(f):
    o = f.orders.where(dates.in_month(F.col("o_orderdate"), f.as_of))
    c = f.customer.where(F.col("c_name").like("%00007%"))
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy(
        F.col("c_custkey").alias("employee_id"), F.col("c_name").alias("emp_name")).agg(
        F.count(F.lit(1)).alias("applications"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total_amount"),
        F.max("o_orderstatus").alias("latest_status"))


@query("chart_frame_topn", f"""
SELECT product_name AS x, total_sales AS y, CASE WHEN (SELECT count(DISTINCT category) FROM sales) <= 10
  THEN category END AS color
FROM (SELECT product_name, category, {LIVE_SUM} AS total_sales FROM sales GROUP BY 1, 2)
ORDER BY y DESC, x, color LIMIT 20""", "sales")
def _chart(f):
    g = sales_metrics(f, ["total_sales"], ["product_name", "category"])
    return chart_frame(g, 20, 10)


def chart_frame(df, n: int = 20, max_colors: int = 10):
    """Data of a bar chart: first text column, first numeric column, optional colour, top n rows."""
    numeric = [c for c, t in df.dtypes if t in ("double", "bigint", "int", "float") or t.startswith("decimal")]
    text = [c for c, _ in df.dtypes if c not in numeric]
    if not numeric or not text:
        raise ValueError("a chart needs one text and one numeric column")
    color = F.lit(None).cast("string")
    if len(text) > 1:
        few = df.select(text[1]).distinct().limit(max_colors + 1).count() <= max_colors
        color = F.col(text[1]) if few else color
    out = df.select(F.col(text[0]).alias("x"), F.col(numeric[0]).alias("y"), color.alias("color"))
    return top(out, [F.col("y").desc(), F.col("x"), F.col("color")], n)
