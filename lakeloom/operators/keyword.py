"""Keyword search (BM25), rank fusion and token overlap.

Only words that occur in a query take part: the word list of a document is cut to them before the
first shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.text import tokens
from lakeloom.operators.topk import top_per_group

K1 = 1.2
B = 0.75
RRF_K = 60


DOC_MARK = ""  # stands for the document itself among its words; never a word


def query_terms(queries: DataFrame, query_id: str, text: str) -> DataFrame:
    """Distinct words of each query."""
    return queries.select(F.col(query_id).alias("query_id"),
                          F.explode(F.array_distinct(tokens(text))).alias("term"))


def query_words(docs: DataFrame, doc_id: str, text: str, terms: DataFrame) -> DataFrame:
    """Rows (doc_id, doc_len, term) of the words that some query uses, plus one mark per document.

    The words are cut once. ``explode_outer`` keeps Catalyst from repeating the cut in a filter
    ahead of the explode. Words no query uses are dropped before the only shuffle, which is by
    document: the posting counts and the scores of a document are then computed in one place.
    """
    marked = F.concat(F.coalesce(tokens(text), F.array().cast("array<string>")), F.array(F.lit(DOC_MARK)))
    words = docs.select(F.col(doc_id).alias("doc_id"), marked.alias("_t"))
    # the length is a column before the explode, so that exploded rows do not carry the array
    words = words.withColumn("doc_len", F.size("_t") - 1)
    long = words.select("doc_id", "doc_len", F.explode_outer("_t").alias("_w"))
    long = long.select("doc_id", "doc_len", F.coalesce("_w", F.lit(DOC_MARK)).alias("term"))
    used = terms.select("term").distinct().withColumn("_q", F.lit(True))
    hit = long.join(used, "term", "left").where(F.col("_q").isNotNull() | (F.col("term") == DOC_MARK))
    return hit.select("doc_id", "doc_len", "term").repartition("doc_id")


def bm25_part(avg_len) -> Column:
    """What one word (idf, tf, doc_len) adds to the score of a document."""
    return F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("doc_len") / avg_len))


def rounded_score(part: Column) -> Column:
    """Sum of the parts to four digits, added as whole numbers of 1e-9: no order of words matters."""
    return F.floor((F.sum(F.floor(part * 1e9 + 0.5)) + 50_000) / 100_000) / 1e4


def bm25_scores(docs: DataFrame, doc_id: str, text: str, queries: DataFrame, query_id: str,
                query_text: str) -> DataFrame:
    """(query_id, doc_id, score) for every document that shares a word with the query.

    score = sum over words of ln(1 + (N - df + 0.5)/(df + 0.5)) * tf * (k1 + 1)
            / (tf + k1 * (1 - b + b * len / avg_len))

    Document frequencies, corpus size and scores all read the same shuffle. For a corpus that is asked
    again, ``postings.KeywordIndex`` gives the same scores without reading the texts.
    """
    terms = query_terms(queries, query_id, query_text)
    words = query_words(docs, doc_id, text, terms)
    mark = F.col("term") == DOC_MARK
    # doc_len is named in every reader, so that all of them want the same columns of the shuffle
    stats = words.agg(F.count(F.when(mark, F.col("doc_len"))).alias("n"), F.sum(F.when(mark, F.col("doc_len"))).alias("total"))
    n = stats.select("n").scalar()
    avg_len = stats.select(F.col("total") / F.col("n")).scalar()
    tf = words.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"), F.max("doc_len").alias("doc_len"))
    df = tf.groupBy("term").agg(F.count("doc_len").alias("df"))
    q = terms.join(df, "term").withColumn("idf", F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5)))
    return tf.join(q, "term").groupBy("query_id", "doc_id").agg(rounded_score(bm25_part(avg_len)).alias("score"))


def bm25_topk(docs: DataFrame, doc_id: str, text: str, queries: DataFrame, query_id: str,
              query_text: str, k: int) -> DataFrame:
    scores = bm25_scores(docs, doc_id, text, queries, query_id, query_text)
    return top_per_group(scores, ["query_id"], [F.col("score").desc(), F.col("doc_id")], k)


def rrf(ranked: list[tuple[str, DataFrame]], k: int, constant: int = RRF_K) -> DataFrame:
    """Reciprocal rank fusion of ranked lists (query_id, item_id, score, rn).

    final = sum over lists of 1 / (constant + rank). The score of each list is kept in its own
    column, NULL where the list does not hold the item.
    """
    names = [n for n, _ in ranked]
    union = None
    for name, df in ranked:
        part = df.select("query_id", "item_id", F.lit(name).alias("src"), "score", "rn")
        union = part if union is None else union.unionByName(part)
    fused = union.groupBy("query_id", "item_id").agg(
        *[F.max(F.when(F.col("src") == n, F.col("score"))).alias(f"{n}_score") for n in names],
        F.round(F.sum((1.0 / (constant + F.col("rn"))).cast("decimal(18,12)")).cast("double"), 8).alias("final_score"))
    return top_per_group(fused, ["query_id"], [F.col("final_score").desc(), F.col("item_id")], k)
