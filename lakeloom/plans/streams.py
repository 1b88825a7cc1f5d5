"""Streaming jobs run to completion over the driver tables, and their batch twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.operators.maintained import MaintainedSummary
from lakeloom.operators.textjobs import trailing_zscore
from lakeloom.plans.evaluation_queries import DAILY_SQL
from lakeloom.plans.registry import query
from lakeloom.plans.text_jobs import zscore_sql
from lakeloom.session import shared_dir
from lakeloom.streaming import jobs
from lakeloom.streaming.recent import RecentMessages, recent_stream
from lakeloom.streaming.sinks import UpsertLog


def log_for(f, name: str, keys: list[str], schema) -> tuple[UpsertLog, str]:
    root = shared_dir(f.spark, name)
    return UpsertLog(f.spark, f"{root}/log", keys, schema), f"{root}/checkpoint"


def drain(q) -> None:
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def schema_of(f, ddl: str):
    return f.spark.createDataFrame([], ddl).schema


@query("stream_index_refresh")
def _index(f):
    log, cp = log_for(f, "index", ["doc_id"], schema_of(f, "doc_id long, n_tokens long, terms array<string>"))
    drain(jobs.index_stream(jobs.table_stream(f.spark, f.folder, "documents"), log, cp))
    return log.latest().select("doc_id", "n_tokens", F.size("terms").alias("n_terms"))


@query("stream_available_now")
def _available_now(f):
    """Two scheduled runs: the second finds nothing new."""
    log, cp = log_for(f, "embed", ["chunk_id"], schema_of(f, "chunk_id string, doc_id long, vec array<float>"))
    for _ in range(2):
        drain(jobs.embed_stream(jobs.table_stream(f.spark, f.folder, "documents"), log, cp))
    return log.read_all().groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("chunk_id").alias("chunks"))


@query("tumbling_5min", "SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, count(*) AS n FROM events GROUP BY 1")
def _tumbling(f):
    w = jobs.windowed_counts(jobs.table_stream(f.spark, f.folder, "events"), "ts", "5 minutes", "10 minutes")
    log, cp = log_for(f, "tumbling", ["window_start"], w.schema)
    drain(jobs.upsert_stream(w, log, cp))
    return log.latest()


def quality_stream(f):
    class Streamed(type(f)):
        @property
        def events(self):
            return jobs.table_stream(self.spark, self.folder, "events")
    return Streamed(f.spark, f.folder).quality_log()


@query("stream_daily_stats", DAILY_SQL, "quality_log")
def _daily(f):
    s = jobs.daily_stats(quality_stream(f))
    log, cp = log_for(f, "daily", ["date"], s.schema)
    drain(jobs.upsert_stream(s, log, cp))
    return log.latest()


@query("stream_apply_changes", """WITH l AS (SELECT c_custkey, op, c_acctbal FROM changes QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY seq DESC) = 1)
SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM l) UNION ALL SELECT c_custkey, c_acctbal FROM l WHERE op <> 'D'""", "changes")
def _changes(f):
    e = jobs.table_stream(f.spark, f.folder, "events")
    ch = e.select(F.col("user_id").alias("c_custkey"), F.col("event_id").alias("seq"),
                  F.expr("CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END").alias("op"),
                  F.col("value").alias("c_acctbal"))
    log, cp = log_for(f, "changes", ["c_custkey"], ch.schema)
    drain(jobs.change_stream(ch, log, cp, "c_custkey"))
    return jobs.merged(f.customer.select("c_custkey", "c_acctbal"), log, "c_custkey")


@query("maintained_summary", """WITH l AS (SELECT user_id, event_type, ts, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1),
r AS (SELECT o_orderdate AS day, o_orderstatus AS status, o_totalprice AS price FROM orders WHERE o_orderkey NOT IN (SELECT user_id FROM l)
UNION ALL SELECT ts, event_type, value FROM l WHERE event_type <> 'error')
SELECT CAST(date_trunc('month', day) AS DATE) AS month, status, CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS sum_price FROM r GROUP BY 1, 2""")
def _summary(f):
    """Monthly summary of all orders, then kept up to date by a stream of changes to them (months move, orders come and go)."""
    def month(at):
        return F.to_date(F.date_trunc("month", at)).alias("month")

    price = "decimal(18,2)"
    root = shared_dir(f.spark, "maintained")
    kept = MaintainedSummary(f.spark, f"{root}/summary", "o_orderkey", "month", ["status"], ["price"],
                             f"o_orderkey bigint, month date, status string, price {price}")
    kept.apply(f.orders.select("o_orderkey", month("o_orderdate"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").cast(price).alias("price"),
                               F.lit(-1).alias("seq"), F.lit("I").alias("op")), 0)
    e = jobs.table_stream(f.spark, f.folder, "events")
    changes = e.select(F.col("user_id").alias("o_orderkey"), month("ts"), F.col("event_type").alias("status"), F.col("value").cast(price).alias("price"),
                       F.col("event_id").alias("seq"), F.expr("CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END").alias("op"))
    drain(jobs.summary_stream(changes, kept, f"{root}/checkpoint"))
    return kept.summary().withColumn("sum_price", F.col("sum_price").cast("double"))


@query("stream_conversation")
def _conversation(f):
    s = jobs.conversation_stream(jobs.table_stream(f.spark, f.folder, "conversations"), 20)
    log, cp = log_for(f, "conversation", ["conv_id"], s.schema)
    drain(jobs.upsert_stream(s, log, cp))
    return log.latest()


@query("stream_recent_messages", """WITH m AS (SELECT conv_id, turn, role, text, TIMESTAMP '2024-01-01' + to_seconds(conv_id * 60 + turn) AS said_at FROM conversations
  WHERE conv_id IS NOT NULL AND turn IS NOT NULL QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY role DESC, text DESC) = 1),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS n FROM m)
SELECT conv_id, CAST(count(*) AS INTEGER) AS n_kept, string_agg(coalesce(role, '') || ': ' || coalesce(text, ''), chr(10) ORDER BY turn) AS history, max(said_at) AS last_at,
  max(said_at) >= (SELECT max(said_at) FROM m) - INTERVAL 1 HOUR AS live FROM t WHERE n <= 20 GROUP BY 1""")
def _recent(f):
    """Last 20 messages of every conversation; live are those heard from within the last hour (messages are a second, conversations a minute apart)."""
    s = jobs.table_stream(f.spark, f.folder, "conversations").withColumn(
        "at", F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, conv_id * 60 + turn)"))
    root = shared_dir(f.spark, "recent")
    kept = RecentMessages(f.spark, f"{root}/state", "conv_id", "turn", "at", "conv_id bigint, turn bigint, role string, text string, at timestamp_ntz", 20, 3600)
    drain(recent_stream(s, kept, f"{root}/checkpoint"))
    lines = F.transform("messages", lambda m: F.concat(F.coalesce(m.role, F.lit("")), F.lit(": "), F.coalesce(m.text, F.lit(""))))
    return kept.state().select("conv_id", F.size("messages").alias("n_kept"), F.array_join(lines, "\n").alias("history"), "last_at", "live")


@query("stream_anomaly", "SELECT day, n, CAST(total AS DOUBLE) AS total, zscore, is_anomaly FROM (" + zscore_sql(
    "SELECT 'all' AS series, CAST(ts AS DATE) AS day, count(*) AS n, sum(CAST(value AS DECIMAL(18,2))) AS total FROM events GROUP BY 2", "series", "day", "total") + ")")
def _anomaly(f):
    m = jobs.daily_metric(jobs.table_stream(f.spark, f.folder, "events"), "ts", "value")
    log, cp = log_for(f, "anomaly", ["day"], m.schema)
    drain(jobs.upsert_stream(m, log, cp))
    days = log.latest().withColumn("series", F.lit("all"))
    return trailing_zscore(days, ["series"], "day", "total").select(
        "day", "n", F.col("total").cast("double").alias("total"), "zscore", "is_anomaly")
