"""Data quality checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeloom.functions.numbers import count_if, pct
from lakeloom.operators import quality
from lakeloom.operators.aggregates import value_distribution
from lakeloom.operators.day_profiles import DayProfiles
from lakeloom.operators.quality import Rule
from lakeloom.operators.sampling import estimated_failures
from lakeloom.plans.registry import drawn_sql, query
from lakeloom.plans.text_jobs import zscore_sql
from lakeloom.session import shared_dir

PROFILE_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


@query("dq_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS n_distinct, "
    f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM orders" for c in PROFILE_COLS))
def _profile(f):
    return quality.profile(f.orders, PROFILE_COLS)


SRC_COLS = ["source_id", "module_name", "ai_summary", "source_code"]


@query("dq_null_columns", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null, count(*) AS n_rows, round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 2) AS null_pct FROM src"
    for c in SRC_COLS), "src")
def _nulls(f):
    return quality.null_columns(f.src(), SRC_COLS)


@query("dq_value_distribution", "SELECT o_orderstatus AS value, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 2) AS share_pct FROM orders GROUP BY 1")
def _distribution(f):
    return value_distribution(f.orders, "o_orderstatus")


@query("dq_date_range", "SELECT CAST(min(o_orderdate) AS DATE) AS first_date, CAST(max(o_orderdate) AS DATE) AS last_date FROM orders")
def _range(f):
    return f.orders.agg(F.to_date(F.min("o_orderdate")).alias("first_date"), F.to_date(F.max("o_orderdate")).alias("last_date"))


@query("dq_row_count", "SELECT count(*) AS n_rows FROM lineitem")
def _rows(f):
    return f.lineitem.agg(F.count(F.lit(1)).alias("n_rows"))


RULES = [Rule("quantity_positive", "l_quantity > 0", 2.0), Rule("discount_range", "l_discount BETWEEN 0 AND 0.05", 1.0),
         Rule("return_flag_known", "l_returnflag IN ('A', 'N', 'R')", 1.0), Rule("line_limit", "l_linenumber <= 6", 0.5)]
RULES_SQL = " UNION ALL ".join(
    f"SELECT '{r.name}' AS rule, count(CASE WHEN {r.predicate} THEN 1 END) AS passed, count(*) - count(CASE WHEN {r.predicate} THEN 1 END) AS failed, "
    f"{r.weight}::DOUBLE AS weight FROM lineitem" for r in RULES)
RULES_SQL = f"SELECT *, round(failed * 100.0::DOUBLE / (passed + failed), 2) AS fail_pct, CASE WHEN failed = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({RULES_SQL})"
SCORE = "round(greatest(0.0::DOUBLE, 100.0::DOUBLE - CAST(sum(CAST(weight * fail_pct AS DECIMAL(18,6))) AS DOUBLE) / sum(weight)), 2) AS score"


@query("dq_rules", RULES_SQL)
def _rules(f):
    return quality.check_rules(f.lineitem, RULES)


@query("dq_score", f"SELECT {SCORE} FROM ({RULES_SQL})")
def _score(f):
    return quality.score(quality.check_rules(f.lineitem, RULES))


METRICS = """SELECT metric, day, value FROM (SELECT CAST(ts AS DATE) AS day, count(*) AS n, count(CASE WHEN event_type <> 'error' THEN 1 END) AS k,
sum(CAST(value AS DECIMAL(18,2))) AS s FROM events GROUP BY 1) CROSS JOIN LATERAL (VALUES ('row_count', CAST(n AS DECIMAL(18,4))),
('null_pct', CAST((n - k) * 100::DOUBLE / n AS DECIMAL(18,4))), ('mean_value', CAST(CAST(s AS DOUBLE) / n AS DECIMAL(18,4)))) t(metric, value)"""


def daily_metrics(f):
    e = f.events.withColumn("known", F.when(F.col("event_type") != "error", F.lit(1)))
    return quality.run_metrics(e, "ts", "value", "known")


ANOMALY_SQL = f"SELECT metric, day, CAST(value AS DOUBLE) AS value, zscore, is_anomaly FROM ({zscore_sql(METRICS, 'metric', 'day', 'value')})"


@query("dq_anomaly", ANOMALY_SQL)
def _anomaly(f):
    return quality.metric_anomalies(daily_metrics(f)).withColumn("value", F.col("value").cast("double"))


@query("dq_findings", f"""SELECT 'rule' AS kind, rule AS name, DATE '2024-01-30' AS run_date, CAST(failed AS DOUBLE) AS amount FROM ({RULES_SQL}) WHERE failed > 0
UNION ALL SELECT 'anomaly', metric, day, zscore FROM ({ANOMALY_SQL}) WHERE is_anomaly""")
def _findings(f):
    r = quality.check_rules(f.lineitem, RULES).where("failed > 0").select(
        F.lit("rule").alias("kind"), F.col("rule").alias("name"), F.lit(f.events_as_of.date()).alias("run_date"), F.col("failed").cast("double").alias("amount"))
    a = quality.metric_anomalies(daily_metrics(f)).where("is_anomaly").select(
        F.lit("anomaly").alias("kind"), F.col("metric").alias("name"), F.col("day").alias("run_date"), F.col("zscore").alias("amount"))
    return r.unionByName(a)


@query("dq_trend", """WITH s AS (SELECT CAST(ts AS DATE) AS run_date, round(100.0::DOUBLE - count(CASE WHEN event_type = 'error' THEN 1 END) * 100.0::DOUBLE / count(*), 2) AS score FROM events GROUP BY 1)
SELECT run_date, score, round(score - lag(score) OVER (ORDER BY run_date), 2) AS change FROM s""")
def _trend(f):
    # one row per run date: the window sees days, not events
    s = f.events.groupBy(F.to_date("ts").alias("run_date")).agg(
        F.round(100.0 - count_if(F.col("event_type") == "error") * 100.0 / F.count(F.lit(1)), 2).alias("score"))
    return s.withColumn("change", F.round(F.col("score") - F.lag("score").over(W.orderBy("run_date")), 2))


@query("dq_cross_column", """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE abs(CAST(l_extendedprice AS DECIMAL(18,2)) - CAST(l_quantity AS DECIMAL(18,0)) * CAST(p_retailprice AS DECIMAL(18,2))) > 10000""")
def _cross_column(f):
    li = f.lineitem.join(f.part.select(F.col("p_partkey").alias("l_partkey"), "p_retailprice"), "l_partkey")
    bad = quality.cross_column(li, "cast(l_extendedprice as decimal(18,2))",
                               "cast(l_quantity as decimal(18,0)) * cast(p_retailprice as decimal(18,2))", "10000")
    return bad.select("l_orderkey", "l_linenumber", "l_partkey")


@query("dq_sampled_scan")
def _sampled(f):
    """Rule results of a hash sample next to the full scan."""
    full = quality.check_rules(f.lineitem, RULES).select("rule", F.col("fail_pct").alias("full_fail_pct"))
    part = quality.check_rules(quality.hash_sample(f.lineitem, "l_orderkey", 10), RULES).select(
        "rule", F.col("fail_pct").alias("sample_fail_pct"), (F.col("passed") + F.col("failed")).alias("sample_rows"))
    return full.join(part, "rule")


LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query("dq_sample_estimates", f"""WITH d AS (SELECT *, {drawn_sql(7, *LINE_KEY)} / 281474976710656.0::DOUBLE AS u, count(*) OVER (PARTITION BY l_returnflag) AS big FROM lineitem),
r AS ({" UNION ALL ".join(f"SELECT '{r.name}' AS rule, l_returnflag, u, big, ({r.predicate}) IS NOT TRUE AS bad FROM d" for r in RULES)}),
g AS (SELECT rule, l_returnflag, big::DOUBLE AS big, (count(*) FILTER (u < 2000.0::DOUBLE / big))::DOUBLE AS n,
  (count(*) FILTER (bad AND u < 2000.0::DOUBLE / big))::DOUBLE AS k FROM r GROUP BY rule, l_returnflag, r.big),
e AS (SELECT rule, sum(n)::BIGINT AS sample_rows, sum(big) FILTER (n > 0) AS big, 100 * sum(big * k / n) FILTER (n > 0) / sum(big) FILTER (n > 0) AS est,
  CASE WHEN count(*) FILTER (n < 2 AND n < big) = 0 THEN sqrt(sum(CASE WHEN n = big THEN 0 ELSE big * big * (1 - n / big) * (k / n) * (1 - k / n) / (n - 1) END)) END AS sd FROM g GROUP BY 1),
b AS (SELECT rule, sample_rows, round(est, 3) AS estimate_pct, CASE WHEN sd IS NOT NULL THEN round(greatest(0.0::DOUBLE, est - 100 * 1.96::DOUBLE * sd / big), 3) END AS low_pct,
  CASE WHEN sd IS NOT NULL THEN round(least(100.0::DOUBLE, est + 100 * 1.96::DOUBLE * sd / big), 3) END AS high_pct FROM e),
w AS (SELECT rule, round(100.0::DOUBLE * sum(bad::INT) / count(*), 3) AS full_pct FROM r GROUP BY 1)
SELECT b.*, full_pct, full_pct BETWEEN low_pct AND high_pct AS covered FROM b JOIN w USING (rule)""")
def _sample_estimates(f):
    """Failure shares from a stratified sample with their intervals, next to the full scan."""
    part = estimated_failures(f.lineitem, LINE_KEY, ["l_returnflag"], RULES, 2000, 7)
    full = quality.check_rules(f.lineitem, RULES).select("rule", F.round(100.0 * F.col("failed") / (F.col("passed") + F.col("failed")), 3).alias("full_pct"))
    return part.join(full, "rule").withColumn("covered", F.col("full_pct").between(F.col("low_pct"), F.col("high_pct")))


EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


@query("dq_profile_days", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null, CAST(min({c}) AS VARCHAR) AS min_value, "
    f"CAST(max({c}) AS VARCHAR) AS max_value, count(DISTINCT {c}) AS n_exact, true AS distinct_within FROM events" for c in EVENT_COLUMNS))
def _profile_days(f):
    """Profile of all events from kept days, the last one added again; the sketches' distinct counts are held against exact ones.

    ``distinct_within`` allows three standard errors (5 %).
    """
    days = DayProfiles(f.spark, shared_dir(f.spark, "day-profiles"), f.events.schema, "ts")
    days.add(f.events)
    days.add_day(f.events, f.events_as_of.date())
    exact = quality.exact_distinct(f.events, EVENT_COLUMNS)
    within = F.abs(F.col("n_distinct") - F.col("n_exact")) <= 0.05 * F.col("n_exact")
    return days.period().join(exact, "column_name").select("column_name", "n_rows", "n_null", "min_value", "max_value", "n_exact",
                                                           within.alias("distinct_within"))


@query("dq_daily_slice", """SELECT event_type, count(*) AS n, round(count(CASE WHEN value > 400 THEN 1 END) * 100.0::DOUBLE / count(*), 2) AS high_pct
FROM events WHERE ts >= TIMESTAMP '2024-01-29' AND ts < TIMESTAMP '2024-01-30' GROUP BY 1""")
def _slice(f):
    day = f.events_as_of.date() - dt.timedelta(days=1)
    n = F.count(F.lit(1))
    return quality.day_slice(f.events, "ts", day).groupBy("event_type").agg(
        n.alias("n"), pct(count_if(F.col("value") > 400), n, 2).alias("high_pct"))


@query("dq_duplicates", "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _duplicates(f):
    return quality.duplicates(f.lineitem, ["l_orderkey", "l_linenumber"])


@query("dq_orphans", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _orphans(f):
    return quality.orphans(f.documents, "doc_id", f.labels, "doc_id").select("doc_id", "lang")
