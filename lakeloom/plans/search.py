"""Chunking, vector search, keyword search, contexts, access rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.functions.numbers import pct
from lakeloom.functions.text import tokens
from lakeloom.functions.vectors import cosine
from lakeloom.operators import chunking, ivf, keyword, retrieval, vectors
from lakeloom.operators.dml import stable_id
from lakeloom.operators.encoders import embed_hashing
from lakeloom.operators.joins import contains_join, insert_missing
from lakeloom.operators.topk import top, top_per_group
from lakeloom.operators.postings import KeywordIndex, file_state
from lakeloom.plans.registry import query
from lakeloom.session import cut_lineage, shared_dir

CJK = r"[\p{{Han}}\p{{Hiragana}}\p{{Katakana}}ー]"
PAIRS = (f"flatten(list_transform(regexp_extract_all(w, '{CJK}+|{CJK.replace('[', '[^', 1)}+'), lambda r: CASE WHEN "
         f"regexp_matches(r, '{CJK}') AND length(r) > 1 THEN list_transform(range(1, length(r)), lambda i: substring(r, i, 2)) ELSE [r] END))")
WORDS = (r"flatten(list_transform(list_filter(string_split_regex(lower({}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> ''), lambda w: "
         f"CASE WHEN regexp_matches(w, '{CJK}') THEN {PAIRS} ELSE [w] END))")


def bm25_sql(docs: str, doc_id: str, text: str, queries: str, query_id: str, query_text: str) -> str:
    """CTEs that end in bm(query_id, doc_id, score)."""
    return rf"""
bd AS ({docs}), bq AS ({queries}),
tok AS (SELECT {doc_id} AS doc_id, unnest({WORDS.format(text)}) AS term FROM bd),
dl AS (SELECT doc_id, count(*) AS doc_len FROM tok GROUP BY 1),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY 1, 2),
dfr AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
st AS (SELECT (SELECT count(*) FROM bd) AS n, (SELECT count(*) FROM tok)::DOUBLE / (SELECT count(*) FROM bd) AS avg_len),
qt AS (SELECT DISTINCT {query_id} AS query_id, unnest({WORDS.format(query_text)}) AS term FROM bq),
bm AS (SELECT query_id, doc_id, round(CAST(sum(CAST(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE
  / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * doc_len / avg_len)) AS DECIMAL(18,9))) AS DOUBLE), 4) AS score
  FROM qt JOIN tf USING (term) JOIN dfr USING (term) JOIN dl USING (doc_id) CROSS JOIN st GROUP BY 1, 2)"""


def ranked_sql(rel: str, k: int, cols: str = "query_id, doc_id, score", order: str = "score DESC, doc_id",
               key: str = "query_id") -> str:
    return (f"(SELECT {cols}, CAST(row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS INT) AS rn FROM {rel} "
            f"QUALIFY rn <= {k})")


LINE_CHUNKS = """(SELECT doc_id, lang, source, CAST(pos - 1 AS INT) AS chunk_index, trim(c) AS chunk_text FROM (
  SELECT doc_id, lang, source, generate_subscripts(string_split(text, chr(10)), 1) AS pos,
  unnest(string_split(text, chr(10))) AS c FROM documents))"""

# ---- chunks ------------------------------------------------------------------------------------


@query("chunk_lines", f"SELECT doc_id, chunk_index, chunk_text FROM {LINE_CHUNKS} WHERE length(chunk_text) > 10")
def _chunk_lines(f):
    return chunking.chunk_lines(f.documents, ["doc_id"], "text")


@query("chunk_lines_nonblank", f"SELECT doc_id, chunk_index, chunk_text FROM {LINE_CHUNKS} WHERE chunk_text <> ''")
def _chunk_nonblank(f):
    return chunking.chunk_nonblank(f.documents, ["doc_id"], "text")


@query("chunk_fixed", """SELECT doc_id, CAST(i AS INT) AS chunk_index, substr(text, CAST(i * 400 + 1 AS BIGINT), 500) AS chunk_text FROM (
SELECT doc_id, text, unnest(range(0, CAST(greatest(ceil((length(text) - 100) / 400.0::DOUBLE), 1) AS BIGINT))) AS i FROM documents)""")
def _chunk_fixed(f):
    return chunking.chunk_fixed(f.texts, ["doc_id"], "text", 500, 100)


@query("chunk_profile", f"""SELECT doc_id, count(*) AS chunks, min(chunk_index) AS first_index, max(length(chunk_text)) AS longest,
arg_min(left(chunk_text, 40), chunk_index) AS preview FROM {LINE_CHUNKS} WHERE length(chunk_text) > 10 GROUP BY 1""")
def _chunk_profile(f):
    c = chunking.chunk_lines(f.documents, ["doc_id"], "text")
    return c.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("chunks"), F.min("chunk_index").alias("first_index"),
        F.max(F.length("chunk_text")).cast("long").alias("longest"),
        F.min_by(F.left("chunk_text", F.lit(40)), "chunk_index").alias("preview"))


# ---- vectors -----------------------------------------------------------------------------------

@query("embed_hashing")
def _embed(f):
    return embed_hashing(f.texts, ["doc_id"], "text", 256)


@query("embedding_status", """SELECT d.lang, CASE WHEN e.embedding IS NULL THEN 'NULL' ELSE 'OK' END AS status, count(*) AS n
FROM documents d LEFT JOIN embeddings e ON d.doc_id = e.vec_id GROUP BY 1, 2""")
def _status(f):
    e = f.embeddings.select(F.col("vec_id").alias("doc_id"), F.lit(True).alias("has"))
    return f.documents.select("doc_id", "lang").join(e, "doc_id", "left").groupBy(
        "lang", F.when(F.col("has"), "OK").otherwise("NULL").alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("pair_similarity_quality", """SELECT CASE WHEN a.label = b.label THEN 'same' ELSE 'other' END AS pair_type, count(*) AS pairs,
round(CAST(sum(CAST(round(list_cosine_similarity(a.embedding, b.embedding), 6) AS DECIMAL(18,6))) AS DOUBLE) / count(*), 4) AS avg_similarity,
round(min(round(list_cosine_similarity(a.embedding, b.embedding), 6)), 4) AS min_similarity,
round(max(round(list_cosine_similarity(a.embedding, b.embedding), 6)), 4) AS max_similarity
FROM vectors a JOIN vectors b ON a.vec_id < b.vec_id GROUP BY 1""", "vectors")
def _pair_quality(f):
    return vectors.pair_quality(f.embeddings, "vec_id", "embedding", "label")


SCORES = """(SELECT q.query_id, v.vec_id, round(list_cosine_similarity(v.embedding, q.query_vec), 6) AS score
FROM vectors v CROSS JOIN query_vectors q)"""
VQ = "vectors query_vectors"


def label_topk(f, k: int, threshold: float | None = None):
    return vectors.topk(f.embeddings, "vec_id", "embedding", f.query_vectors(), "query_id", "query_vec", k, threshold)


@query("cross_join_scores", f"""SELECT query_id, count(*) AS n_scored, count(CASE WHEN score >= 0.2 THEN 1 END) AS n_above,
round(CAST(sum(CAST(score AS DECIMAL(18,6))) AS DOUBLE) / count(*), 4) AS mean_score, max(score) AS best_score
FROM {SCORES} GROUP BY 1""", VQ)
def _cross(f):
    return vectors.score_stats(f.embeddings, "embedding", f.query_vectors(), "query_id", "query_vec", 0.2)


@query("vector_topk", """SELECT vec_id, round(list_cosine_similarity(embedding, (SELECT arg_min(embedding, vec_id) FROM vectors)), 6) AS score
FROM vectors ORDER BY score DESC, vec_id LIMIT 5""", "vectors")
def _topk(f):
    q = f.embeddings.agg(F.min("vec_id").alias("qid"), F.min_by("embedding", "vec_id").alias("qv"))
    hits = vectors.topk(f.embeddings, "vec_id", "embedding", q, "qid", "qv", 5)
    return hits.select(F.col("item_id").alias("vec_id"), "score")


@query("vector_topk_threshold", f"""SELECT 'before' AS mode, query_id, vec_id, score FROM {ranked_sql(
    f"(SELECT * FROM {SCORES} WHERE score >= 0.3)", 3, "query_id, vec_id, score", "score DESC, vec_id")}
UNION ALL SELECT 'after', query_id, vec_id, score FROM {ranked_sql(SCORES, 3, "query_id, vec_id, score", "score DESC, vec_id")} WHERE score > 0.3""", VQ)
def _topk_threshold(f):
    before = label_topk(f, 3, 0.3).select(F.lit("before").alias("mode"), "query_id", F.col("item_id").alias("vec_id"), "score")
    after = label_topk(f, 3).where("score > 0.3").select(F.lit("after").alias("mode"), "query_id",
                                                         F.col("item_id").alias("vec_id"), "score")
    return before.unionByName(after)


@query("batch_vector_topk", f"""SELECT query_id, vec_id, score, rn FROM {ranked_sql(
    f"(SELECT * FROM {SCORES} WHERE score >= 0.2)", 5, "query_id, vec_id, score", "score DESC, vec_id")}""", VQ)
def _batch_topk(f):
    return label_topk(f, 5, 0.2).withColumnRenamed("item_id", "vec_id")


_IVF: dict[tuple[str, str], tuple[ivf.IvfIndex, int]] = {}


def vector_index(f) -> ivf.IvfIndex:
    """The inverted-file index of ``embeddings``: made on first use in an application, anew when the files have changed."""
    key = (f.spark.sparkContext.applicationId, f.folder)
    index, seen = _IVF.get(key, (None, None))
    now = file_state(f.embeddings)
    if seen != now:
        index = ivf.build(f.embeddings, "vec_id", "embedding", shared_dir(f.spark, "vector-index"))
        _IVF[key] = index, now
    return index


def ann_hits(f, k: int = 10):
    """Neighbours from the index of every vector whose id is divisible by 50, with their recall against the exact answer."""
    q = f.embeddings.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    index = vector_index(f)
    approx = index.topk(q, "query_id", "query_vec", k)
    exact = vectors.topk(f.embeddings, "vec_id", "embedding", q, "query_id", "query_vec", k)
    return approx, vectors.recall_at_k(exact, approx), index.share_read(q, "query_id", "query_vec")


@query("ann_topk")
def _ann(f):
    approx, recall, _ = ann_hits(f)
    return approx.join(recall, "query_id").select("query_id", "item_id", "score", "rn", F.round("recall", 4).alias("recall"))


@query("ann_recall", "SELECT count(*) FILTER (vec_id % 50 = 0) AS n_queries, true AS recall_reached FROM vectors", "vectors")
def _ann_recall(f):
    """Whether the index finds nine of ten exact neighbours of these vectors."""
    _, recall, _ = ann_hits(f)
    return recall.agg(F.count(F.lit(1)).alias("n_queries"), (F.avg("recall") >= 0.9).alias("recall_reached"))


@query("encoder_compare")
def _encoders(f):
    """Overlap of the ten nearest documents under a 768- and a 1024-dimension encoder."""
    q = f.benchmark.select("item_id", "text")
    lists = []
    for dim in (768, 1024):
        hits = vectors.topk(embed_hashing(f.texts, ["doc_id"], "text", dim), "doc_id", "vec",
                            embed_hashing(q, ["item_id"], "text", dim), "item_id", "vec", 10)
        lists.append(hits.select("query_id", "item_id"))
    both = lists[0].join(lists[1], ["query_id", "item_id"]).groupBy("query_id").agg(F.count(F.lit(1)).alias("shared"))
    return q.select(F.col("item_id").alias("query_id")).join(both, "query_id", "left").select(
        "query_id", (F.coalesce("shared", F.lit(0)) / 10).alias("overlap_at_10"))


# ---- keyword and hybrid search -----------------------------------------------------------------

_INDEXES: dict[tuple[str, str], tuple[KeywordIndex, int]] = {}


def document_index(f) -> KeywordIndex:
    """The keyword index of ``documents``: made on first use in an application, refreshed when the files have changed."""
    key = (f.spark.sparkContext.applicationId, f.folder)
    index, seen = _INDEXES.get(key, (None, None))
    now = file_state(f.documents)
    if seen != now:
        index = index or KeywordIndex(f.spark, shared_dir(f.spark, "keyword-index"))
        _INDEXES[key] = index.refresh(f.texts.withColumn("version", F.xxhash64("text"))), now
    return index


DOCS = "SELECT doc_id, text, lang, source FROM documents"
QUESTIONS = "SELECT item_id, text FROM benchmark"
BM = bm25_sql(DOCS, "doc_id", "text", QUESTIONS, "item_id", "text")


@query("bm25_search", f"WITH {BM} SELECT query_id, doc_id, score, rn FROM {ranked_sql('bm', 3)}")
def _bm25(f):
    return document_index(f).topk(f.benchmark, "item_id", "text", 3)


def title_queries(f):
    """Query vectors with a text: the first line of the query's document."""
    d = f.documents.select(F.col("doc_id").alias("query_id"), F.expr(r"split_part(text, '\n', 1)").alias("query"))
    return cut_lineage(f.query_vectors().join(d, "query_id"))  # a handful of rows, read by several branches


TITLES = "SELECT query_id, split_part(text, chr(10), 1) AS query FROM query_vectors JOIN documents ON query_id = doc_id"
BM_TITLES = bm25_sql(DOCS, "doc_id", "text", TITLES, "query_id", "query")


@query("hybrid_rrf", f"""WITH {BM_TITLES},
dense AS (SELECT * FROM {ranked_sql(SCORES, 20, "query_id, vec_id AS doc_id, score", "score DESC, vec_id")}),
sparse AS (SELECT * FROM {ranked_sql('bm', 20)}),
fused AS (SELECT query_id, doc_id, max(CASE WHEN src = 'dense' THEN score END) AS dense_score,
  max(CASE WHEN src = 'sparse' THEN score END) AS sparse_score,
  round(CAST(sum(CAST(1.0::DOUBLE / (60 + rn) AS DECIMAL(18,12))) AS DOUBLE), 8) AS final_score
  FROM (SELECT 'dense' AS src, * FROM dense UNION ALL SELECT 'sparse', * FROM sparse) GROUP BY 1, 2)
SELECT query_id, doc_id, dense_score, sparse_score, final_score, rn FROM {ranked_sql(
    'fused', 5, "query_id, doc_id, dense_score, sparse_score, final_score", "final_score DESC, doc_id")}""", VQ)
def _hybrid(f):
    q = title_queries(f)
    dense = vectors.topk(f.embeddings, "vec_id", "embedding", q, "query_id", "query_vec", 20)
    sparse = document_index(f).topk(q, "query_id", "query", 20).withColumnRenamed("doc_id", "item_id")
    return keyword.rrf([("dense", dense), ("sparse", sparse)], 5).withColumnRenamed("item_id", "doc_id")


@query("rerank", f"""WITH {BM_TITLES}, cand AS (SELECT * FROM {ranked_sql('bm', 20)})
SELECT query_id, doc_id, keyword_score, score, rn FROM {ranked_sql('''(SELECT c.query_id, c.doc_id, c.score AS keyword_score,
  round(list_cosine_similarity(v.embedding, q.query_vec), 6) AS score FROM cand c JOIN vectors v ON c.doc_id = v.vec_id
  JOIN query_vectors q ON c.query_id = q.query_id)''', 5, "query_id, doc_id, keyword_score, score")}""", VQ)
def _rerank(f):
    """Keyword search finds twenty candidates per query, the exact vector score orders them."""
    q = title_queries(f)
    cand = document_index(f).topk(q, "query_id", "query", 20)
    v = f.embeddings.select(F.col("vec_id").alias("doc_id"), "embedding")
    scored = cand.join(v, "doc_id").join(q.select("query_id", "query_vec"), "query_id").select(
        "query_id", "doc_id", F.col("score").alias("keyword_score"), F.round(cosine("embedding", "query_vec"), 6).alias("score"))
    return top_per_group(scored, ["query_id"], [F.col("score").desc(), F.col("doc_id")], 5)


@query("multi_column_search", "WITH " + bm25_sql(
    "SELECT source_id, concat_ws(' ', ai_summary, module_name, function_name, file_name) AS body FROM src", "source_id", "body",
    "SELECT min(source_id) AS qid, module_name || ' ' || function_name AS q FROM src GROUP BY module_name, function_name", "qid", "q")
    + f" SELECT query_id, doc_id, score, rn FROM {ranked_sql('bm', 3)}", "src")
def _multi_column(f):
    src = f.src()
    body = src.select("source_id", F.concat_ws(" ", "ai_summary", "module_name", "function_name", "file_name").alias("body"))
    q = src.groupBy("module_name", "function_name").agg(F.min("source_id").alias("qid")).select(
        "qid", F.concat_ws(" ", "module_name", "function_name").alias("q"))
    return keyword.bm25_topk(body, "source_id", "body", q, "qid", "q", 3)


FILTERS = {
    "search_filter_eq": ({"@eq": {"lang": "fr"}}, "lang = 'fr'"),
    "search_filter_or": ({"@or": [{"@eq": {"source": "src3"}}, {"@eq": {"lang": "de"}}]}, "source = 'src3' OR lang = 'de'"),
    "search_filter_and": ({"@and": [{"@eq": {"lang": "en"}}, {"@or": [{"@eq": {"source": "src1"}}, {"@eq": {"source": "src2"}}]}]},
                          "lang = 'en' AND (source = 'src1' OR source = 'src2')"),
}


def search(f, request_filter=None, k: int = 3, columns=("doc_id", "lang", "source")):
    """Keyword search for every benchmark question; the filter applies before scoring."""
    docs = f.documents.where(retrieval.filter_column(request_filter))
    hits = document_index(f).topk(f.benchmark, "item_id", "text", k, docs if request_filter else None)
    return hits.join(docs.select(*columns), "doc_id")


for _name, (_spec, _where) in FILTERS.items():
    query(_name, f"WITH {bm25_sql(DOCS + ' WHERE ' + _where, 'doc_id', 'text', QUESTIONS, 'item_id', 'text')}"
          f" SELECT query_id, doc_id, score, rn, lang, source FROM {ranked_sql('bm', 3)} JOIN documents USING (doc_id)")(
        lambda f, spec=_spec: search(f, spec))


@query("search_results", f"WITH {BM} SELECT query_id, source, text, score FROM {ranked_sql('bm', 2)} JOIN documents USING (doc_id)")
def _results(f):
    return search(f, k=2, columns=("doc_id", "source", "text")).select("query_id", "source", "text", "score")


@query("search_batch", f"WITH {BM} SELECT query_id, b.text AS question, doc_id, score, rn FROM {ranked_sql('bm', 5)} r JOIN benchmark b ON r.query_id = b.item_id")
def _batch(f):
    hits = document_index(f).topk(f.benchmark, "item_id", "text", 5)
    return hits.join(f.benchmark.select(F.col("item_id").alias("query_id"), F.col("text").alias("question")), "query_id").select(
        "query_id", "question", "doc_id", "score", "rn")


# ---- index upkeep ------------------------------------------------------------------------------

SEEN_UNTIL = "2024-01-15"


def dated_documents(f):
    return f.documents.select("doc_id", "text", (F.lit("2024-01-01").cast("timestamp_ntz")
                              + F.make_dt_interval(hours=F.col("doc_id"))).alias("updated_at"))


def stale_index(f) -> KeywordIndex:
    """An index that lacks new and late documents (id % 10 = 3), and still holds old versions (id % 10 = 4) and deleted documents."""
    every = dated_documents(f).withColumn("version", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss"))
    old = every.where((F.col("updated_at") <= F.lit(SEEN_UNTIL).cast("timestamp_ntz")) & (F.col("doc_id") % 10 != 3))
    old = old.withColumn("version", F.when(F.col("doc_id") % 10 == 4, F.lit("draft")).otherwise(F.col("version"))) \
        .withColumn("text", F.when(F.col("doc_id") % 10 == 4, F.concat(F.lit("draft "), "text")).otherwise(F.col("text")))
    gone = every.where("doc_id % 10 = 5").withColumn("doc_id", -1 - F.col("doc_id"))  # ids no document has
    index = KeywordIndex(f.spark, shared_dir(f.spark, "refreshed-index"))
    index.refresh(old.unionByName(gone))
    return index.refresh(every)


@query("index_refresh", f"""SELECT doc_id, CAST(len({WORDS.format('text')}) AS BIGINT) AS n_tokens,
TIMESTAMP '2024-01-01' + to_hours(doc_id) AS updated_at,
TIMESTAMP '2024-01-01' + to_hours(doc_id) > TIMESTAMP '2024-01-15' OR doc_id % 10 IN (3, 4) AS refreshed FROM documents""")
def _refresh(f):
    """State of a stale index after its refresh: what was cut again, and nothing of the deleted documents."""
    return stale_index(f).documents().select(
        "doc_id", F.col("doc_len").cast("long").alias("n_tokens"), F.col("version").cast("timestamp_ntz").alias("updated_at"),
        (F.col("gen") > 1).alias("refreshed"))


@query("search_after_refresh", f"WITH {BM} SELECT query_id, doc_id, score, rn FROM {ranked_sql('bm', 3)}")
def _search_after_refresh(f):
    """The refreshed index answers like one of the present documents."""
    return stale_index(f).topk(f.benchmark, "item_id", "text", 3)


@query("index_coverage", """SELECT module_name, count(*) AS total, count(ai_summary) AS has_summary, count(*) - count(ai_summary) AS missing,
round(count(ai_summary) * 100.0::DOUBLE / count(*), 1) AS coverage_pct FROM src GROUP BY ROLLUP (module_name)""", "src")
def _coverage(f):
    n, has = F.count(F.lit(1)), F.count("ai_summary")
    return f.src().rollup("module_name").agg(n.alias("total"), has.alias("has_summary"), (n - has).alias("missing"),
                                             pct(has, n).alias("coverage_pct"))


# ---- contexts ----------------------------------------------------------------------------------

def hits_with_text(f, k: int, threshold: float | None = None):
    """Top documents of each query vector with their text; only k rows per query meet the texts."""
    hits = label_topk(f, k, threshold)
    d = f.documents.select(F.col("doc_id").alias("item_id"), F.col("text").alias("chunk_text"), "source",
                           F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("doc_name"))
    return hits.join(d, "item_id")


HITS = f"""(SELECT h.query_id, h.vec_id, h.score, h.rn, d.text AS chunk_text, d.source, 'doc_' || d.doc_id AS doc_name
FROM {ranked_sql(SCORES, 3, "query_id, vec_id, score", "score DESC, vec_id")} h JOIN documents d ON h.vec_id = d.doc_id)"""


@query("context_assembly", f"""SELECT query_id, string_agg('【' || doc_name || '】: ' || chunk_text, chr(10) || chr(10) ORDER BY rn) AS context_text
FROM {HITS} GROUP BY 1""", VQ)
def _context(f):
    return retrieval.context_text(hits_with_text(f, 3), ["query_id"])


@query("citations", f"""SELECT query_id, string_agg('[' || rn || '] 【' || doc_name || '】: ' || chunk_text, chr(10) || chr(10) ORDER BY rn) AS context_text,
string_agg('[' || rn || '] ' || doc_name || ' (類似度: ' || printf('%.4f', score) || ')', ' | ' ORDER BY rn) AS sources FROM {HITS} GROUP BY 1""", VQ)
def _citations(f):
    return retrieval.citations(hits_with_text(f, 3), ["query_id"])


@query("source_structs", f"""SELECT query_id, list({{'rank': rn, 'doc_name': doc_name, 'source': source, 'score': score}} ORDER BY rn) AS sources,
count(*) AS n_sources FROM {HITS} GROUP BY 1""", VQ)
def _sources(f):
    return retrieval.source_structs(hits_with_text(f, 3), ["query_id"], ["doc_name", "source", "score"])


@query("prompt_rows", f"""SELECT query_id, '=== 参考文書 ===' || chr(10) || c || chr(10) || chr(10) || '=== 質問 ===' || chr(10) || split_part(d.text, chr(10), 1) AS prompt
FROM (SELECT query_id, string_agg('【' || doc_name || '】: ' || chunk_text, chr(10) || chr(10) ORDER BY rn) AS c FROM {HITS} GROUP BY 1)
JOIN documents d ON d.doc_id = query_id""", VQ)
def _prompts(f):
    ctx = retrieval.context_text(hits_with_text(f, 3), ["query_id"])
    return ctx.join(title_queries(f), "query_id").select("query_id", retrieval.prompt("query").alias("prompt"))


@query("fallback_answer", f"""SELECT query_id, max_score, CASE WHEN max_score >= 0.3 THEN names
ELSE '申し訳ありませんが、関連する情報が見つかりませんでした。' END AS answer FROM (SELECT query_id, max(score) AS max_score,
string_agg(doc_name, ',' ORDER BY rn) AS names FROM {HITS} WHERE vec_id <> query_id GROUP BY 1)""", VQ)
def _fallback(f):
    h = hits_with_text(f, 3).where("item_id <> query_id")
    g = h.groupBy("query_id").agg(F.max("score").alias("max_score"), retrieval.ordered_text(F.col("doc_name"), ["rn"], ",").alias("names"))
    return g.select("query_id", "max_score", retrieval.answer_or_fallback("max_score", 0.3, F.col("names")).alias("answer"))


def hybrid_context(metric_rows, metric_cols, doc_hits, excerpt: int | None = None):
    """Metric rows and document excerpts as one text; both inputs are short ordered results."""
    line = F.concat_ws(" ", *[F.col(c).cast("string") for c in metric_cols])
    metrics = metric_rows.agg(retrieval.ordered_text(line, ["rn"], "\n").alias("m"))
    part = F.concat(F.lit("--- "), F.col("doc_name"), F.lit(" ---\n"),
                    F.left("chunk_text", F.lit(excerpt)) if excerpt else F.col("chunk_text"))
    docs = doc_hits.groupBy("query_id").agg(retrieval.ordered_text(part, ["rn"], "\n\n").alias("d"))
    return docs.withColumn("m", metrics.scalar()).select(
        "query_id", F.concat(F.lit(retrieval.STRUCTURED_HEADER), "m", F.lit("\n\n" + retrieval.RELATED_HEADER), "d").alias("context"))


@query("hybrid_context", f"""SELECT query_id, '【構造化データ集計結果】' || chr(10) || (SELECT string_agg(category || ' ' || n, chr(10) ORDER BY n DESC, category) FROM (
SELECT p_type AS category, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY n DESC, category))
|| chr(10) || chr(10) || '【関連ドキュメント】' || chr(10) || string_agg('--- ' || doc_name || ' ---' || chr(10) || chunk_text, chr(10) || chr(10) ORDER BY rn) AS context
FROM {HITS} GROUP BY 1""", VQ)
def _hybrid_context(f):
    from pyspark.sql import Window
    g = f.lineitem.join(f.part, F.col("l_partkey") == F.col("p_partkey")).groupBy(
        F.col("p_type").alias("category")).agg(F.count(F.lit(1)).alias("n"))
    m = g.withColumn("rn", F.row_number().over(Window.orderBy(F.col("n").desc(), "category")))  # a row a category
    return hybrid_context(m, ["category", "n"], hits_with_text(f, 3))


@query("scoped_vector_topk", f"""SELECT product_name, vec_id, score, rn FROM {ranked_sql('''(SELECT t.product_name, v.vec_id,
round(list_cosine_similarity(v.embedding, (SELECT arg_min(embedding, vec_id) FROM vectors)), 6) AS score
FROM (SELECT p_name AS product_name FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3) t
JOIN manuals m ON m.file_name LIKE '%' || t.product_name || '%' JOIN vectors v ON v.vec_id = m.doc_id)''', 3,
"product_name, vec_id, score", "score DESC, vec_id", "product_name")}""", "vectors manuals")
def _scoped(f):
    """Vector search inside the manuals of the three best-selling products, matched by file name."""
    best = top(f.lineitem.join(f.part, F.col("l_partkey") == F.col("p_partkey")).groupBy(
        F.col("p_name").alias("product_name")).agg(F.count(F.lit(1)).alias("n")),
        [F.col("n").desc(), F.col("product_name")], 3).select("product_name")
    files = contains_join(f.manuals().select("doc_id", "file_name"), "file_name", best, "product_name")
    v = f.embeddings.select(F.col("vec_id").alias("doc_id"), "embedding")
    qv = f.embeddings.agg(F.min_by("embedding", "vec_id")).scalar()
    scored = files.join(v, "doc_id").withColumn("_q", qv).select(
        "product_name", F.col("doc_id").alias("vec_id"), F.round(cosine("embedding", "_q"), 6).alias("score"))
    return top_per_group(scored, ["product_name"], [F.col("score").desc(), F.col("vec_id")], 3)


@query("lang_routing", """SELECT doc_id, lang, CASE WHEN lang = 'en' THEN 'index' ELSE 'translate' END AS route,
CAST(len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')) AS BIGINT) AS chunk_count FROM documents""")
def _routing(f):
    out = route_and_chunk(f.documents, "en", lambda lang, texts: texts)
    n = out.groupBy("doc_id").agg(F.count(F.lit(1)).alias("chunk_count"))
    d = f.documents.select("doc_id", "lang", F.when(F.col("lang") == "en", "index").otherwise("translate").alias("route"))
    return d.join(n, "doc_id", "left").select("doc_id", "lang", "route", F.coalesce("chunk_count", F.lit(0).cast("long")).alias("chunk_count"))


def route_and_chunk(docs, target: str, translate):
    """Documents in other languages pass a translation plug-in, then all are cut into lines."""
    import pandas as pd

    def run(batches):
        for b in batches:
            for lang, g in b.groupby("lang", sort=False):
                yield pd.DataFrame({"doc_id": g["doc_id"], "lang": lang, "text": translate(lang, g["text"].tolist())})

    other = docs.where(F.col("lang") != target).select("doc_id", "lang", "text").mapInPandas(
        run, "doc_id long, lang string, text string")
    own = docs.where(F.col("lang") == target).select("doc_id", "lang", "text")
    return chunking.chunk_nonblank(own.unionByName(other), ["doc_id", "lang"], "text")


@query("row_access", """SELECT 'Supplier#000000003' AS user_name, doc_id, source FROM documents WHERE source IN (SELECT department FROM principals
WHERE user_name = 'Supplier#000000003') UNION ALL SELECT 'admin', doc_id, source FROM documents""", "principals")
def _access(f):
    d = f.documents.select("doc_id", "source")
    out = []
    for user, admin in (("Supplier#000000003", False), ("admin", True)):
        out.append(retrieval.row_access(d, "source", f.principals(), user, admin).select(F.lit(user).alias("user_name"), "doc_id", "source"))
    return out[0].unionByName(out[1])


@query("train_val_split", """WITH p AS (SELECT md5(a.conv_id || '|' || a.turn) AS pair_id, a.text AS prompt, b.text AS completion
FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 AND b.role = 'assistant' WHERE a.role = 'user')
SELECT pair_id, prompt, completion, CASE WHEN pair_id IN (SELECT pair_id FROM p ORDER BY pair_id LIMIT 20) THEN 'validation' ELSE 'train' END AS split FROM p""")
def _split(f):
    a = f.conversations.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("prompt"))
    b = f.conversations.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("completion"))
    pairs = a.join(b, ["conv_id", "turn"]).select(stable_id("conv_id", "turn").alias("pair_id"), "prompt", "completion")
    return disjoint_split(pairs, "pair_id", 20)


def disjoint_split(pairs, key: str, n: int):
    """Validation sample of n rows in key order (keys are digests), the rest is for training."""
    val = top(pairs.select(key), [F.col(key)], n).withColumn("split", F.lit("validation"))
    return pairs.join(val, key, "left").withColumn("split", F.coalesce("split", F.lit("train")))


# ---- sales questions that end in documents -----------------------------------------------------

@query("top5_products_docs", """SELECT t.product_name, t.total_sales, m.doc_id, m.file_name FROM (
SELECT product_name, CAST(sum(total_amount) AS DOUBLE) AS total_sales FROM sales WHERE status <> 'cancelled'
AND order_date >= DATE '2001-06-01' AND order_date < DATE '2001-07-01' GROUP BY 1 ORDER BY total_sales DESC, 1 LIMIT 5) t
JOIN manuals m ON m.file_name LIKE '%' || t.product_name || '%'""", "sales manuals")
def _top5_docs(f):
    from lakeloom.plans.business import top_products
    best = top_products(f, 5).select("product_name", "total_sales")
    return contains_join(f.manuals().select("doc_id", "file_name"), "file_name", best, "product_name").select(
        "product_name", "total_sales", "doc_id", "file_name")


@query("top1_doc_lookup", f"""WITH t AS (SELECT product_name FROM sales WHERE status <> 'cancelled' AND order_date >= DATE '2001-07-01'
AND order_date < DATE '2001-08-01' GROUP BY 1 ORDER BY sum(total_amount) DESC, 1 LIMIT 1),
{bm25_sql("SELECT m.* FROM manuals m JOIN t ON m.file_name LIKE '%' || t.product_name || '%'", "doc_id", "concat_ws(' ', file_name, text)",
          "SELECT 1 AS qid, product_name AS q FROM t", "qid", "q")}
SELECT product_name, doc_id, score, rn FROM {ranked_sql('bm', 3)} CROSS JOIN t""", "sales manuals")
def _top1_docs(f):
    from lakeloom.plans.business import top_products
    best = top_products(f, 1, 0).select("product_name")
    docs = contains_join(f.manuals().select("doc_id", "file_name", "text"), "file_name", best, "product_name")
    docs = docs.withColumn("body", F.concat_ws(" ", "file_name", "text"))
    hits = keyword.bm25_topk(docs, "doc_id", "body", best.withColumn("qid", F.lit(1)), "qid", "product_name", 3)
    return hits.withColumn("product_name", best.scalar()).select("product_name", "doc_id", "score", "rn")


@query("metric_to_search")
def _metric_to_search(f):
    """Change of every category drives a document search for its name."""
    from lakeloom.plans.business import month_pair
    change = month_pair(f, ["category"], f.sales("product")).select("category", "change_pct")
    q = change.withColumn("qid", F.crc32(F.col("category").cast("binary")))
    m = f.manuals().select("doc_id", F.concat_ws(" ", "category", "file_name", "text").alias("body"))
    hits = keyword.bm25_topk(m, "doc_id", "body", q, "qid", "category", 3)
    return q.join(hits, q.qid == hits.query_id).select("category", "change_pct", "doc_id", "score", "rn")


@query("process_documents")
def _process(f):
    """Chunk, embed only what has no vector yet, report how many chunks were added."""
    chunks = chunking.chunk_lines(f.documents, ["doc_id", "lang"], "text").withColumn("chunk_id", stable_id("doc_id", "chunk_index"))
    done = chunks.where("lang = 'en'").select("chunk_id")
    new = insert_missing(chunks, done, "chunk_id")
    return embed_hashing(new, ["chunk_id", "doc_id", "chunk_index"], "chunk_text", 64).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("new_chunks"), F.concat(F.lit("embedded "), F.count(F.lit(1)).cast("string"), F.lit(" chunks")).alias("message"))
