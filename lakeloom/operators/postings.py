"""Keyword index on disk: postings by term, kept up to date document by document.

A refresh writes one generation: the postings (term, doc_id, tf, doc_len) of new and changed documents,
partitioned by a hash of the term, one mark per document with its version, and the (document, generation) pairs
that it puts out of use. Nothing older is rewritten. A search reads only the partitions of the words that the
queries use; postings out of use fall away by an anti join with the usually short list of dead pairs. The
numbers of the corpus (documents, words) are written with each generation, which counts only once they are.

The best documents are found in the tasks: a posting moves once, to its document, as numbers; a task adds up the
scores of some documents at a time and keeps the best k of each query. Pairs of query and document, of which common words
make nearly all, are never rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.text import tokens
from lakeloom.operators.keyword import B, DOC_MARK, K1, bm25_part, query_terms, rounded_score
from lakeloom.operators.topk import top_per_group

BUCKETS = 64
MOST_TERMS = 500_000  # words of all queries that may travel to the postings; beyond, postings are shuffled to them
MOST_AMONG = 2_000_000  # documents of a search filter whose ids may travel to the postings
MOST_ADDED = 1 << 20  # additions to scores that a task makes at a time
POSTED = 1 << 16  # postings that leave a task at a time
KEPT = 1 << 18  # candidates of a task beyond which the best of each query are taken
MARKS = -1  # partition of the document marks
POSTINGS = "doc_id bigint, term string, tf bigint, doc_len int, version string, gen int, bucket int"
DEAD = "doc_id bigint, dead_gen int, gen int"
STATS = "n bigint, words bigint, gen int"


def bucket_of(term: str, buckets: int):
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def runs(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(first row of each run of equal ids, run of each row); nulls are equal."""
    null = ids.is_null().to_numpy(zero_copy_only=False)
    other = pc.fill_null(pc.not_equal(ids[1:], ids[:-1]), False).to_numpy(zero_copy_only=False) | (null[1:] != null[:-1])
    new = np.r_[np.ones(min(len(ids), 1), bool), other]
    return np.flatnonzero(new), np.cumsum(new) - 1


def postings_of(batches):
    """Postings (doc_id, term, tf, doc_len, version) of documents (doc_id, version, words, the last of them the mark) in order of doc_id.

    Rows that share an id are one document: frequencies add up, of lengths and versions the largest counts. Only the mark has
    a version. Of a document that may go on in the next batch the postings are kept.
    """
    names = ["doc_id", "term", "tf", "doc_len", "version"]

    def counted(b: pa.RecordBatch) -> pa.Table:
        lists, (starts, run) = b.column("words"), runs(b.column("doc_id"))
        words, size = lists.flatten().dictionary_encode(), pc.list_value_length(lists).to_numpy()
        row = np.repeat(np.arange(b.num_rows), size)
        key = run[row] * len(words.dictionary) + words.indices.to_numpy()
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        at, word = np.divmod(key[first], len(words.dictionary))
        length = np.maximum.reduceat((size[row] - 1)[order], first)
        mark = word == words.dictionary.index(DOC_MARK).as_py()
        newest = b.column("version")
        if len(starts) < b.num_rows:
            each = newest.to_pylist()
            newest = pa.array([max(each[a:z]) for a, z in zip(starts, [*starts[1:], len(each)])], pa.string())
        return pa.table([b.column("doc_id").take(pa.array(starts[at])), words.dictionary.take(pa.array(word)), np.diff(np.r_[first, len(key)]),
                         length.astype(np.int32), newest.take(pa.array(at, mask=~mark))], names)

    rest = None
    for b in batches:
        if not b.num_rows:
            continue
        t = counted(b)
        if rest is not None:
            a = int(np.r_[runs(t.column("doc_id").combine_chunks())[0], t.num_rows][1])
            both = pa.concat_tables([rest, t.slice(0, a)])
            if len(runs(both.column("doc_id").combine_chunks())[0]) == 1:  # the document goes on
                both = both.group_by(["doc_id", "term"]).aggregate([("tf", "sum"), ("doc_len", "max"), ("version", "max")])
                t = pa.concat_tables([pa.table([both.column(c) for c in ("doc_id", "term", "tf_sum", "doc_len_max", "version_max")], names), t.slice(a)])
            else:
                yield from rest.to_batches()
        last = int(runs(t.column("doc_id").combine_chunks())[0][-1])
        yield from t.slice(0, last).to_batches(max_chunksize=POSTED)
        rest = t.slice(last)
    if rest is not None:
        yield from rest.to_batches()


class KeywordIndex:
    """Index under ``root``. Documents have a unique ``doc_id``, a ``text`` and a ``version`` that changes with the text."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root, buckets
        self.generation, self.n, self.words = 0, 0, 0

    def open(self) -> KeywordIndex:
        """Take up an index that another session has written."""
        last = self._read("stats", STATS).orderBy(F.desc("gen")).first()
        self.n, self.words, self.generation = last.n, last.words, last.gen
        return self

    def _read(self, part: str, ddl: str) -> DataFrame:
        path = f"{self.root}/{part}"
        return self.spark.read.schema(ddl).option("basePath", path).parquet(path)

    def _write(self, df: DataFrame, part: str, *by: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by).parquet(
            f"{self.root}/{part}/gen={self.generation + 1}")

    def live(self, buckets: list[int]) -> DataFrame:
        """Postings in use of some partitions."""
        rows = self._read("postings", POSTINGS).where(F.col("bucket").isin(buckets) & (F.col("gen") <= self.generation))
        if self.generation < 2:
            return rows
        dead = self._read("dead", DEAD).where(F.col("gen") <= self.generation).select("doc_id", F.col("dead_gen").alias("gen"))
        return rows.join(dead, ["doc_id", "gen"], "left_anti")

    def documents(self) -> DataFrame:
        """doc_id, version, doc_len, gen (the refresh that brought this version) of the documents in the index."""
        return self.live([MARKS]).select("doc_id", "version", "doc_len", "gen")

    def refresh(self, docs: DataFrame, gone: bool = True) -> KeywordIndex:
        """Bring the index to the state of ``docs``: only new and changed texts are cut into words.

        Ids and versions alone decide what is read. With ``gone`` documents that are not in ``docs`` leave the index; without
        it, ``docs`` may be the new and changed ones alone. A refresh that fails can be run again.
        """
        docs = docs.select("doc_id", "text", F.coalesce(F.col("version").cast("string"), F.lit("")).alias("version"))
        if self.generation:
            state, now = self.documents(), docs.select("doc_id", "version")
            same = state.join(now, ["doc_id", "version"], "left_semi")
            changed = docs.join(same.select("doc_id"), "doc_id", "left_anti")
            old = state.join(same.select("doc_id"), "doc_id", "left_anti") if gone else state.join(changed.select("doc_id"), "doc_id", "left_semi")
            self._write(old.select("doc_id", F.col("gen").alias("dead_gen")), "dead")
        else:
            changed = docs
        words = F.coalesce(tokens("text"), F.array().cast("array<string>"))
        placed = changed.repartition("doc_id").sortWithinPartitions("doc_id")  # rows of one id are one document
        cut = placed.select("doc_id", "version", F.concat(words, F.array(F.lit(DOC_MARK))).alias("words"))
        schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType)]).add("term", "string").add("tf", "long") \
            .add("doc_len", "integer").add("version", "string")
        posted = cut.mapInArrow(postings_of, schema)
        posted = posted.withColumn("bucket", F.when(F.col("term") == DOC_MARK, F.lit(MARKS)).otherwise(bucket_of("term", self.buckets)))
        # one folder a partition of terms; a partition that is large is written by several tasks
        self._write(posted.hint("rebalance", "bucket"), "postings", "bucket")
        self.generation += 1
        got = self.documents().agg(F.count("doc_id").alias("n"), F.coalesce(F.sum("doc_len"), F.lit(0)).cast("bigint").alias("words")).first()
        self.n, self.words = got.n, got.words
        self.spark.createDataFrame([(got.n, got.words)], "n bigint, words bigint").coalesce(1).write.mode("overwrite").parquet(
            f"{self.root}/stats/gen={self.generation}")
        return self

    def compact(self, root: str) -> KeywordIndex:
        """The same index as one generation under a new root; switch readers over once it has returned."""
        fresh = KeywordIndex(self.spark, root, self.buckets)
        every = self.live([MARKS, *range(self.buckets)]).drop("gen")
        fresh._write(every.hint("rebalance", "bucket"), "postings", "bucket")
        self.spark.createDataFrame([(self.n, self.words)], "n bigint, words bigint").coalesce(1).write.mode("overwrite").parquet(f"{root}/stats/gen=1")
        return fresh.open()

    def _hits(self, terms: DataFrame, among: DataFrame | None, cut):
        """(postings in use of the partitions that the words lie in, ``cut`` to the words; number of documents, their mean length)."""
        hit = cut(self.live([r["bucket"] for r in terms.select("bucket").distinct().collect()]))  # at most ``buckets`` rows
        n, avg_len = F.lit(self.n), F.lit(self.words / max(self.n, 1))
        if among is not None:
            among = among.select("doc_id")
            if among.count() <= MOST_AMONG:  # else postings are shuffled to them
                among = F.broadcast(among)
            hit = hit.join(among, "doc_id", "left_semi")
            sums = self.documents().join(among, "doc_id", "left_semi").agg(F.count("doc_id").alias("n"), F.sum("doc_len").alias("words"))
            n, avg_len = sums.select("n").scalar(), sums.select(F.col("words") / F.col("n")).scalar()
        return hit, n, avg_len

    def _terms(self, queries: DataFrame, query_id: str, text: str) -> DataFrame:
        return query_terms(queries, query_id, text).withColumn("bucket", bucket_of("term", self.buckets))

    def _shuffled(self, terms: DataFrame, among: DataFrame | None) -> DataFrame:
        """(query_id, doc_id, score) of more words than may travel."""
        words = terms.select("bucket", "term").distinct()
        hit, n, avg_len = self._hits(terms, among, lambda rows: rows.join(words, ["bucket", "term"], "left_semi"))
        # each posting moves once, to its document; frequencies and scores read that one shuffle
        hit = hit.select("doc_id", "term", "tf", "doc_len").repartition("doc_id")
        df = hit.groupBy("term").agg(F.count("doc_id").alias("df"))
        q = terms.join(df, "term").withColumn("idf", F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5)))
        part = bm25_part(avg_len)
        return hit.join(q.select("query_id", "term", "idf"), "term").groupBy("query_id", "doc_id").agg(rounded_score(part).alias("score"))

    def _best(self, asked: pa.Table, terms: DataFrame, k: int, among: DataFrame | None) -> DataFrame:
        """(query_id, doc_id, score) that hold the best k of each query; ``asked`` are the terms."""
        words, ids = (asked.column(c).combine_chunks().dictionary_encode("encode") for c in ("term", "query_id"))
        word, query = (x.indices.to_numpy().astype(np.int64) for x in (words, ids))
        names = self.spark.createDataFrame(pa.table({"w": pa.array(np.arange(len(words.dictionary))), "term": words.dictionary}))
        hit, n, avg_len = self._hits(terms, among, lambda rows: rows.join(F.broadcast(names), "term").select("w", "doc_id", "tf", "doc_len"))
        df = hit.groupBy("w").agg(F.count("doc_id").alias("df"))
        found = df.select("w", F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"), avg_len.alias("avg_len")).toArrow()
        idf = np.zeros(len(words.dictionary))
        idf[found.column("w").to_numpy()] = found.column("idf").to_numpy()
        avg = found.column("avg_len")[0].as_py() if found.num_rows else None
        order = np.argsort(word, kind="stable")
        first = np.searchsorted(word[order], np.arange(len(idf) + 1))
        shared = self.spark.sparkContext.broadcast((idf, first, query[order], len(ids.dictionary)))
        placed = hit.repartition("doc_id").sortWithinPartitions("doc_id")
        best = placed.mapInArrow(lambda batches: best_of(batches, *shared.value, avg or 1.0, k), "_q bigint, doc_id bigint, score double")
        numbers = self.spark.createDataFrame(pa.table({"_q": pa.array(np.arange(len(ids.dictionary))), "query_id": ids.dictionary}))
        return best.join(F.broadcast(numbers), "_q").select("query_id", "doc_id", "score")

    def topk(self, queries: DataFrame, query_id: str, text: str, k: int, among: DataFrame | None = None) -> DataFrame:
        """BM25 (query_id, doc_id, score, rn) as ``keyword.bm25_topk``; ``among`` (doc_id) is the corpus that counts."""
        terms = self._terms(queries, query_id, text)
        asked = terms.select("query_id", "term").limit(MOST_TERMS + 1).toArrow()
        pairs = self._best(asked, terms, k, among) if asked.num_rows <= MOST_TERMS else self._shuffled(terms, among)
        return top_per_group(pairs, ["query_id"], [F.col("score").desc(), F.col("doc_id")], k)


def _ranked(query, null, doc, score, k: int) -> np.ndarray:
    """Positions of the best k of each query: score descending, then no id before the smaller id."""
    order = np.lexsort((doc, ~null, -score, query))
    q = query[order]
    return order[np.arange(len(q)) - np.searchsorted(q, q) < k]


def best_of(batches, idf, first, query, queries: int, avg: float, k: int):
    """The best k documents of each query among postings (w, doc_id, tf, doc_len) in order of doc_id.

    Word w counts for the queries ``query[first[w]:first[w + 1]]``. Parts are added as whole numbers of 1e-9, as ``rounded_score`` does.
    """
    kept = [np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64), np.zeros(0)]
    least = np.full(queries, -np.inf)  # the k-th best score of each query so far

    def cut():
        kept[:] = (x[at] for at in [_ranked(*kept, k)] for x in kept)
        size = np.bincount(kept[0], minlength=queries)
        last = np.cumsum(size) - 1  # in order of query and score
        least[size >= k] = kept[3][last[size >= k]]

    def add(w, null, doc, part):
        """Scores of whole documents."""
        times = first[w + 1] - first[w]
        at = np.repeat(np.arange(len(w)), times)
        q = query[np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first[w], times)]
        new = np.r_[True, (doc[1:] != doc[:-1]) | (null[1:] != null[:-1])]
        number, heads = (np.cumsum(new) - 1)[at], np.flatnonzero(new)
        key, of = np.unique(number * queries + q, return_inverse=True) if len(heads) * queries > 4 * MOST_ADDED else (None, number * queries + q)
        total = np.bincount(of, weights=part[at])
        if key is None:
            key = np.flatnonzero(np.bincount(of))
            total = total[key]
        score = np.floor((total + 50_000) / 100_000) / 1e4
        q, d = key % queries, heads[key // queries]
        some = score >= least[q]
        for i, x in enumerate((q[some], null[d[some]], doc[d[some]], score[some])):
            kept[i] = np.concatenate([kept[i], x])
        if len(kept[0]) > KEPT + queries * k:
            cut()

    rest = None
    for b in batches:
        if not b.num_rows:
            continue
        ids = b.column("doc_id")
        null = ids.is_null().to_numpy(zero_copy_only=False)
        w, doc, tf, size = (b.column(c).fill_null(0).to_numpy(zero_copy_only=False) for c in ("w", "doc_id", "tf", "doc_len"))
        part = np.floor(idf[w] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size / avg)) * 1e9 + 0.5)
        rows = [w, null, doc, part] if rest is None else [np.concatenate(x) for x in zip(rest, (w, null, doc, part))]
        w, null, doc, _ = rows
        starts = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (null[1:] != null[:-1])])
        done = np.r_[0, np.cumsum(first[w + 1] - first[w])]
        a = 0
        for i in range(1, len(starts)):  # the last document may go on in the next batch
            if i == len(starts) - 1 or done[starts[i + 1]] - done[a] > MOST_ADDED:
                add(*(x[a:starts[i]] for x in rows))
                a = starts[i]
        rest = [x[a:] for x in rows]
    if rest is not None:
        add(*rest)
    if len(kept[0]):
        cut()
        q, null, doc, score = kept
        for a in range(0, len(q), 10_000):
            s = slice(a, a + 10_000)
            yield pa.RecordBatch.from_arrays([pa.array(q[s]), pa.array(doc[s], mask=null[s]), pa.array(score[s])], ["_q", "doc_id", "score"])


def file_state(table: DataFrame) -> int:
    """A number that changes with the files of a table (names, sizes, times), from footers alone."""
    m = F.col("_metadata")
    one = F.xxhash64(m.file_path, m.file_size, m.file_modification_time).cast("decimal(20,0)")
    got = table.select(m.file_path.alias("p"), one.alias("h")).groupBy("p").agg(F.max("h").alias("h")).agg(F.sum("h")).first()[0]
    return int(got or 0)
