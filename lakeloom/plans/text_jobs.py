"""Text and series jobs over documents, events and sales."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions import dates
from lakeloom.operators import retrieval, textjobs
from lakeloom.operators.aggregates import contribution
from lakeloom.operators.dml import fill_missing
from lakeloom.plans.registry import query
from lakeloom.plans.search import BM, WORDS, document_index, ranked_sql
from lakeloom.sources.inline import values_relation

LEXICON = [("good", "1"), ("great", "1"), ("best", "1"), ("with", "0.5"), ("that", "0.25"), ("bad", "-1"), ("poor", "-1"),
           ("no", "-0.5"), ("not", "-0.5"), ("was", "-0.25"), ("ohne", "-0.5"), ("sans", "-0.5"), ("pero", "-0.25")]
LEXICON_SQL = ", ".join(f"('{t}', CAST({w} AS DECIMAL(6,2)))" for t, w in LEXICON)


@query("sentiment_lexicon", f"""WITH w AS (SELECT doc_id, unnest({WORDS.format('text')}) AS term FROM documents),
g AS (SELECT doc_id, CAST(sum(weight) AS DOUBLE) AS s, count(weight) AS hits FROM w JOIN (VALUES {LEXICON_SQL}) l(term, weight) USING (term) GROUP BY 1)
SELECT d.doc_id, coalesce(hits, 0) AS hits, round(coalesce(s / hits, 0.0), 4) AS score, CASE WHEN s > 0 THEN 'positive' WHEN s < 0 THEN 'negative'
ELSE 'neutral' END AS label FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id""")
def _sentiment(f):
    lex = values_relation(f.spark, ["term", "weight"], [(t, F.lit(w).cast("decimal(6,2)")) for t, w in LEXICON])
    return textjobs.sentiment(f.texts, "doc_id", "text", lex)


SENTENCES = r"""sen AS (SELECT doc_id, generate_subscripts(string_split_regex(text, '[.!?]+\s+|\n+'), 1) - 1 AS pos,
unnest(string_split_regex(text, '[.!?]+\s+|\n+')) AS s FROM documents)"""


@query("summarize_extractive", f"""WITH {SENTENCES},
w AS (SELECT doc_id, pos, unnest({WORDS.format('s')}) AS term FROM sen),
tf AS (SELECT doc_id, term, count(*) AS tf FROM w GROUP BY 1, 2),
sc AS (SELECT doc_id, pos, round(CAST(sum(tf) AS DOUBLE) / count(*), 6) AS score FROM w JOIN tf USING (doc_id, term) GROUP BY 1, 2),
best AS (SELECT doc_id, pos FROM sc QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) <= 2)
SELECT doc_id, string_agg(trim(s), ' / ' ORDER BY pos) AS summary FROM best JOIN sen USING (doc_id, pos) GROUP BY 1""")
def _summarize(f):
    return textjobs.summarize(f.texts, "doc_id", "text", 2)


@query("extract_answer", f"""WITH {BM}, top1 AS (SELECT query_id, doc_id FROM {ranked_sql('bm', 1)}), {SENTENCES},
x AS (SELECT t.query_id, pos, trim(s) AS answer, len(list_intersect(list_distinct({WORDS.format('b.text')}), list_distinct({WORDS.format('s')}))) AS overlap
FROM top1 t JOIN benchmark b ON t.query_id = b.item_id JOIN sen USING (doc_id))
SELECT query_id, CAST(overlap AS BIGINT) AS overlap, answer FROM x QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY overlap DESC, pos) = 1""")
def _extract(f):
    hits = document_index(f).topk(f.benchmark, "item_id", "text", 1)
    pairs = hits.join(f.documents.select("doc_id", F.col("text").alias("context")), "doc_id").join(
        f.benchmark.select(F.col("item_id").alias("query_id"), F.col("text").alias("question")), "query_id")
    return textjobs.extract_answer(pairs, "query_id", "question", "context")


@query("classify_centroid", """WITH d AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM vectors),
c AS (SELECT label, i, CAST(sum(CAST(x AS DECIMAL(30,12))) AS DOUBLE) / count(*) AS x FROM d GROUP BY 1, 2),
cv AS (SELECT label, list(x ORDER BY i) AS c FROM c GROUP BY 1)
SELECT vec_id, CAST(cv.label AS BIGINT) AS predicted, v.label = cv.label AS is_correct FROM vectors v CROSS JOIN cv
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY round(list_cosine_similarity(embedding, c), 6) DESC, cv.label) = 1""", "vectors")
def _classify(f):
    cents = textjobs.centroids(f.embeddings, "label", "embedding")
    out = textjobs.assign_nearest(f.embeddings, "vec_id", "embedding", cents)
    truth = f.embeddings.select(F.col("vec_id").alias("item_id"), F.col("label").alias("truth"))
    return out.join(truth, "item_id").select(F.col("item_id").alias("vec_id"), F.col("label").alias("predicted"),
                                             (F.col("label") == F.col("truth")).alias("is_correct"))


def stub_client(model: str, prompts: list[str]) -> list[str]:
    """Offline stand-in for a text model."""
    return [f"{model}: {len(p)} chars" for p in prompts]


@query("batch_inference")
def _batch_inference(f):
    prompts = f.benchmark.select("item_id", F.col("text").alias("prompt"))
    return retrieval.batch_complete(prompts, ["item_id"], "prompt", ["model-a", "model-b", "model-c"], stub_client)


@query("summary_backfill")
def _backfill(f):
    """Only sources without a summary go to the model; answers are joined back and fill the gaps."""
    src = f.src()
    need = src.where(F.col("ai_summary").isNull() & (F.length("source_code") > 0))
    ans = retrieval.batch_complete(need.select("source_id", F.col("source_code").alias("prompt")),
                                   ["source_id"], "prompt", ["summary-model"], stub_client)
    j = src.join(ans.select("source_id", "answer"), "source_id", "left")
    return fill_missing(j, "ai_summary", F.col("answer"), F.col("answer").isNotNull()).select("source_id", "ai_summary")


@query("forecast_trend", """WITH m AS (SELECT category, CAST(year(order_date) * 12 + month(order_date) - 1 AS INT) AS month_no,
sum(total_amount) AS amount FROM sales WHERE status <> 'cancelled' AND order_date < DATE '2001-07-01' GROUP BY 1, 2),
g AS (SELECT category, count(*) AS n, max(month_no) AS last_x, CAST(sum(month_no) AS DOUBLE) AS sx, CAST(sum(amount) AS DOUBLE) AS sy,
CAST(sum(month_no * month_no) AS DOUBLE) AS sxx, CAST(sum(month_no * amount) AS DOUBLE) AS sxy FROM m GROUP BY 1),
l AS (SELECT *, (n * sxy - sx * sy) / (n * sxx - sx * sx) AS slope FROM g)
SELECT category, CAST(last_x + s AS INT) AS month_no, round((sy - slope * sx) / n + slope * (last_x + s), 0) AS forecast,
(SELECT CAST(amount AS DOUBLE) FROM m WHERE m.category = l.category AND m.month_no = last_x + s - 12) AS same_month_last_year
FROM l CROSS JOIN (VALUES (1), (2), (3)) t(s)""", "sales")
def _forecast(f):
    s = f.sales("product").where((F.col("status") != "cancelled") & (F.col("order_date") < F.lit(dates.month_start(f.as_of))))
    m = s.groupBy("category", (F.year("order_date") * 12 + F.month("order_date") - 1).alias("month_no")).agg(
        F.sum("total_amount").alias("amount"))
    fc = textjobs.linear_forecast(m, "category", "month_no", "amount", 3)
    naive = m.select("category", (F.col("month_no") + 12).alias("month_no"), F.col("amount").cast("double").alias("same_month_last_year"))
    return fc.join(naive, ["category", "month_no"], "left")


DAILY = "SELECT event_type, CAST(ts AS DATE) AS day, sum(CAST(value AS DECIMAL(18,2))) AS total FROM events GROUP BY 1, 2"


def zscore_sql(rel: str, key: str, order: str, value: str, width: int = 7, limit: float = 2.0, cols: str = "") -> str:
    w = f"OVER (PARTITION BY {key} ORDER BY {order} ROWS BETWEEN {width} PRECEDING AND 1 PRECEDING)"
    return f"""SELECT * EXCLUDE (n_, s_, q_, v_), coalesce(abs(zscore) > {limit}, FALSE) AS is_anomaly FROM (SELECT *, CASE WHEN n_ > 1 AND v_ > 1e-9
THEN round((CAST({value} AS DOUBLE) - s_ / n_) / sqrt(v_), 4) END AS zscore FROM (SELECT *, (q_ - s_ * s_ / n_) / (n_ - 1) AS v_ FROM (
SELECT *, count({value}) {w} AS n_, CAST(sum({value}) {w} AS DOUBLE) AS s_, CAST(sum({value} * {value}) {w} AS DOUBLE) AS q_ FROM ({rel}))))"""


@query("anomaly_zscore", f"SELECT event_type, day, CAST(total AS DOUBLE) AS total, zscore, is_anomaly FROM ({zscore_sql(DAILY, 'event_type', 'day', 'total')})")
def _anomaly(f):
    daily = f.events.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.sum(F.col("value").cast("decimal(18,2)")).alias("total"))
    return textjobs.trailing_zscore(daily, ["event_type"], "day", "total").withColumn("total", F.col("total").cast("double"))


CONTRIB = " UNION ALL ".join(f"""SELECT '{d}' AS dimension, {d} AS segment,
CAST(sum(CASE WHEN order_date < DATE '2001-07-01' THEN total_amount ELSE 0 END) AS DOUBLE) AS before_value,
CAST(sum(CASE WHEN order_date >= DATE '2001-07-01' THEN total_amount ELSE 0 END) AS DOUBLE) AS now_value FROM live GROUP BY 2""" for d in ("category", "region", "segment"))


@query("contribution", f"""WITH live AS (SELECT * FROM sales WHERE status <> 'cancelled' AND order_date >= DATE '2001-06-01' AND order_date < DATE '2001-08-01'),
c AS (SELECT *, round(now_value - before_value, 2) AS delta FROM ({CONTRIB}))
SELECT *, round(delta * 100.0::DOUBLE / (SELECT CAST(sum(CAST(delta AS DECIMAL(28,2))) AS DOUBLE) FROM c WHERE dimension = 'category'), 2) AS contribution_pct FROM c""", "sales")
def _contribution(f):
    s = f.sales("product", "geo").where(F.col("status") != "cancelled")
    return contribution(s, ["category", "region", "segment"], F.col("total_amount"),
                        dates.in_month("order_date", f.as_of, -1), dates.in_month("order_date", f.as_of))
