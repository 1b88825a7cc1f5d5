"""Text and series jobs: sentiment, summaries, answers, classes, trends, outliers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.text import tokens
from lakeloom.operators.joins import small_rows
from lakeloom.operators.postings import runs
from lakeloom.operators.vectors import DIGITS, unit_matrix

SENTENCE_BREAK = r"[.!?]+\s+|\n+"


def sentiment(docs: DataFrame, doc_id: str, text: str, lexicon: DataFrame) -> DataFrame:
    """Mean weight of the lexicon words in a text and its label; 0 and neutral without any.

    ``lexicon`` has columns term and weight (decimal).
    """
    words = docs.select(doc_id, F.explode_outer(tokens(text)).alias("term"))
    g = words.join(lexicon, "term", "left").groupBy(doc_id).agg(
        F.sum("weight").cast("double").alias("_s"), F.count("weight").alias("hits"))
    score = F.round(F.coalesce(F.try_divide("_s", "hits"), F.lit(0.0)), 4)
    return g.select(doc_id, "hits", score.alias("score")).withColumn(
        "label", F.when(F.col("score") > 0, "positive").when(F.col("score") < 0, "negative").otherwise("neutral"))


def sentences(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.split(c, SENTENCE_BREAK)


def best_sentences(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Places of the n best sentences of each document among sentences (id, pos, words); those of a document follow each other.

    Of a document that goes on in the next batch only the number of each word in each place is kept.
    """
    def counted(ids, pos, terms, times) -> pa.Table:
        return pa.table({"id": ids, "pos": pos, "term": terms, "n": times})

    def picks(t: pa.Table) -> Iterator[pa.RecordBatch]:
        """Of whole documents."""
        if not t.num_rows:
            return
        t = t.combine_chunks()
        ids, pos, n_of = t.column("id").combine_chunks(), t.column("pos").to_numpy().astype(np.int64), t.column("n").to_numpy()
        words = t.column("term").combine_chunks().dictionary_encode()
        starts, doc = runs(ids)
        _, word = np.unique(doc * len(words.dictionary) + words.indices.to_numpy(), return_inverse=True)
        tf = np.bincount(word, weights=n_of)[word]
        width = int(pos.max()) + 1
        at, place = np.unique(doc * width + pos, return_inverse=True)
        score = np.floor(np.bincount(place, weights=n_of * tf) / np.bincount(place, weights=n_of) * 1e6 + 0.5)
        d, p = at // width, at % width
        order = np.lexsort((p, -score, d))
        rank = np.arange(len(order)) - np.searchsorted(d[order], d[order])
        kept = np.sort(order[rank < n])  # in order of document and place
        lists = pa.ListArray.from_arrays(pa.array(np.r_[np.searchsorted(d[kept], np.arange(len(starts))), len(kept)], pa.int32()), pa.array(p[kept], pa.int32()))
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(starts)), lists], ["_id", "_pos"])

    rest = None
    for b in batches:
        lists = b.column("words")
        size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        row = pa.array(np.repeat(np.arange(b.num_rows), size))
        t = counted(b.column("id").take(row), b.column("pos").take(row), lists.flatten(), pa.array(np.ones(len(row), np.int64)))
        if not t.num_rows:
            continue
        t = t if rest is None else pa.concat_tables([rest, t])
        last = int(runs(t.column("id").combine_chunks())[0][-1])
        yield from picks(t.slice(0, last))
        rest = t.slice(last).group_by(["id", "pos", "term"]).aggregate([("n", "sum")])
        rest = counted(*(rest.column(c) for c in ("id", "pos", "term", "n_sum")))
    if rest is not None:
        yield from picks(rest)


def summarize(docs: DataFrame, doc_id: str, text: str, n: int = 2) -> DataFrame:
    """The n sentences with the highest mean word frequency, in text order.

    A text moves once, to its document; words are counted in the tasks, a document at a time, and are never rows.
    """
    placed = docs.select(doc_id, text).where(F.col(doc_id).isNotNull()).repartition(doc_id)
    s = placed.sortWithinPartitions(doc_id).select(F.col(doc_id).alias("id"), F.posexplode_outer(sentences(text)).alias("pos", "s"))
    schema = T.StructType([T.StructField("_id", docs.schema[doc_id].dataType), T.StructField("_pos", T.ArrayType(T.IntegerType()))])
    picks = s.select("id", "pos", tokens("s").alias("words")).mapInArrow(lambda batches: best_sentences(batches, n), schema)
    best = F.filter(sentences(text), lambda s, i: F.array_contains("_pos", i))
    return placed.join(picks.hint("shuffle_hash"), F.col(doc_id) == F.col("_id")).select(
        doc_id, F.array_join(F.transform(best, lambda s: F.trim(s)), " / ").alias("summary"))


def extract_answer(pairs: DataFrame, question_id: str, question: str, context: str) -> DataFrame:
    """Sentence of the context that shares most distinct words with the question."""
    x = pairs.select(question_id, F.array_distinct(tokens(question)).alias("_q"),
                     F.posexplode(sentences(context)).alias("pos", "answer"))
    hit = F.size(F.array_intersect("_q", F.array_distinct(tokens("answer"))))
    best = x.select(question_id, "pos", F.trim("answer").alias("answer"), hit.cast("long").alias("overlap"))
    b = best.groupBy(question_id).agg(F.max(F.struct("overlap", (-F.col("pos")).alias("_p"), "answer")).alias("b"))
    return b.select(question_id, "b.overlap", "b.answer")


def centroids(df: DataFrame, label: str, vec: str) -> DataFrame:
    """Mean vector per label: each task adds up its batch, only the sums are shuffled."""
    rows = df.where(F.col(vec).isNotNull() & F.col(label).isNotNull()).select(
        F.col(label).cast("long").alias("label"), F.col(vec).alias("vec"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            lab = b.column("label").to_numpy(zero_copy_only=False)
            m = b.column("vec").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b.num_rows, -1)
            keys, inv = np.unique(lab, return_inverse=True)
            sums = np.zeros((len(keys), m.shape[1]))
            np.add.at(sums, inv, m)
            yield pa.RecordBatch.from_pydict({
                "label": pa.array(keys, pa.int64()), "n": pa.array(np.bincount(inv), pa.int64()),
                "total": pa.array(list(sums), pa.list_(pa.float64()))})

    parts = rows.mapInArrow(run, "label long, n long, total array<double>")
    dims = parts.select("label", "n", F.posexplode("total").alias("i", "x")).groupBy("label", "i").agg(
        (F.sum(F.col("x").cast("decimal(30,12)")).cast("double") / F.sum("n")).alias("x"))
    return dims.groupBy("label").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))),
                                                 lambda s: s["x"]).alias("centroid"))


def assign_nearest(df: DataFrame, id_col: str, vec: str, cents: DataFrame, cap: int = 10_000) -> DataFrame:
    """Label of the nearest centroid by cosine. The centroids (checked) travel to the tasks."""
    rows = small_rows(cents.orderBy("label"), cap)
    if rows is None:
        from lakeloom.operators.vectors import topk
        hits = topk(cents, "label", "centroid", df, id_col, vec, 1)
        return hits.select(F.col("query_id").alias("item_id"), F.col("item_id").alias("label"), "score")
    labels = np.array([r["label"] for r in rows])
    cm = unit_matrix([r["centroid"] for r in rows])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                m = unit_matrix(b.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1))
                s = np.round(m @ cm.T, DIGITS)
                best = s.argmax(axis=1)
                yield pa.RecordBatch.from_pydict({"item_id": b.column("item_id"), "label": pa.array(labels[best], pa.int64()),
                                                  "score": pa.array(s[np.arange(len(s)), best])})

    x = df.where(F.col(vec).isNotNull()).select(F.col(id_col).cast("long").alias("item_id"), F.col(vec).alias("vec"))
    return x.mapInArrow(run, "item_id long, label long, score double")


def linear_forecast(series: DataFrame, key: str, x: str, y: str, steps: int) -> DataFrame:
    """Least-squares line per series, continued for ``steps`` points. y is a decimal column."""
    xi = F.col(x).cast("decimal(18,0)")
    g = series.groupBy(key).agg(
        F.count(y).alias("n"), F.max(x).alias("last_x"), F.sum(xi).cast("double").alias("sx"),
        F.sum(y).cast("double").alias("sy"), F.sum(xi * xi).cast("double").alias("sxx"),
        F.sum(xi * F.col(y)).cast("double").alias("sxy"))
    c = F.col
    slope = F.try_divide(c("n") * c("sxy") - c("sx") * c("sy"), c("n") * c("sxx") - c("sx") * c("sx"))
    g = g.withColumn("slope", slope).withColumn("intercept", (c("sy") - c("slope") * c("sx")) / c("n"))
    return g.select(key, F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"), "last_x", "slope", "intercept").select(
        key, (c("last_x") + c("step")).alias(x), F.round(c("intercept") + c("slope") * (c("last_x") + c("step")), 0).alias("forecast"))


def trailing_zscore(series: DataFrame, keys: list[str], order: str, value: str, width: int = 7,
                    limit: float = 2.0) -> DataFrame:
    """Distance of each point from the mean of the ``width`` points before it, in deviations.

    ``value`` is a decimal column of an aggregated series (one row per key and period).
    """
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(-width, -1)
    v = F.col(value)
    out = series.withColumn("_n", F.count(value).over(w)).withColumn("_s", F.sum(v).over(w).cast("double")) \
        .withColumn("_q", F.sum(v * v).over(w).cast("double"))
    mean = F.col("_s") / F.col("_n")
    var = (F.col("_q") - F.col("_s") * F.col("_s") / F.col("_n")) / (F.col("_n") - 1)
    z = F.when((F.col("_n") > 1) & (var > 1e-9), F.round((v.cast("double") - mean) / F.sqrt(var), 4))
    return out.withColumn("zscore", z).withColumn(
        "is_anomaly", F.coalesce(F.abs("zscore") > limit, F.lit(False))).drop("_n", "_s", "_q")
