"""Inverted-file index for nearest neighbours by cosine similarity.

Centroids are fitted on a bounded sample: the SAMPLE rows whose id hashes lowest, whatever the size of the corpus.
Every row is then assigned to its nearest centroid and stored in the order of these lists. A query
reads only the lists of its nearest centroids; how many is chosen when the index is made, as the
smallest number that finds the wanted share of the exact neighbours of a second sample of rows. The number of
lists grows with the root of the corpus, so the rows a query meets grow more slowly than the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeloom.operators import vectors

SAMPLE = 50_000        # rows the centroids are fitted on, at most
TESTED = 200           # rows whose exact neighbours choose the number of probes, at most
MOST_LISTS = 16_384
MOST_BYTES = 64 << 20  # of centroids that travel to the tasks
BLOCK_ROWS = 20_000    # rows of a list that one task scores for a large query set
ROUNDS = 12
MOST_ASKED = 4 << 20   # list numbers of all queries that may travel to the tasks
SCORED = 4 << 20       # scores against centroids held at a time


def nearest(m: np.ndarray, centroids: np.ndarray, n: int = 1) -> np.ndarray:
    """Numbers of the ``n`` nearest centroids of each unit row, nearest first; ties to the lower number."""
    out = np.empty((len(m), n), np.int64)
    step = max(1, min(4096, SCORED // max(1, len(centroids))))
    for a in range(0, len(m), step):
        s = np.round(m[a:a + step] @ centroids.T, vectors.DIGITS)
        out[a:a + step] = np.argsort(-s, axis=1, kind="stable")[:, :n] if n > 1 else s.argmax(axis=1)[:, None]
    return out


def fit(m: np.ndarray, lists: int, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    """Unit centroids of unit rows by spherical k-means; an empty list restarts at the row worst served."""
    rng = np.random.default_rng(seed)
    c = m[rng.permutation(len(m))[:lists]].copy()
    for _ in range(rounds):
        own = nearest(m, c)[:, 0]
        total = np.zeros_like(c)
        np.add.at(total, own, m)
        size = np.bincount(own, minlength=len(c))
        far = np.argsort((m * c[own]).sum(axis=1), kind="stable")
        empty = np.flatnonzero(size == 0)
        total[empty] = m[far[:len(empty)]]
        c = vectors.unit_matrix(total)
    return c


def _matrix(batch: pa.RecordBatch, col: str, dim: int) -> np.ndarray:
    return vectors.unit_matrix(batch.column(col).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dim))


@dataclass
class IvfIndex:
    """``stored`` (item_id, vec, list) in the order of lists, the centroids, and the lists a query reads."""

    stored: DataFrame
    centroids: np.ndarray
    probes: int

    def share_read(self, queries: DataFrame, query_id: str, query_vec: str) -> DataFrame:
        """query_id, read: rows in the lists that each query reads."""
        size = self.stored.groupBy("list").agg(F.count("list").alias("n"))
        return self.probed(queries, query_id, query_vec).join(size, "list").groupBy("query_id").agg(F.sum("n").alias("read"))

    def asked(self, queries: DataFrame, query_id: str, query_vec: str) -> DataFrame:
        """query_id, qvec, lists: the lists that each query reads, nearest first."""
        shared, n = queries.sparkSession.sparkContext.broadcast(self.centroids), min(self.probes, len(self.centroids))
        q = queries.where(F.col(query_vec).isNotNull()).select(F.col(query_id).cast("long").alias("query_id"), F.col(query_vec).cast("array<double>").alias("qvec"))

        def run(batches):
            step = max(1, (1 << 20) // n)
            for b in (b.slice(a, step) for b in batches for a in range(0, b.num_rows, step)):
                got = nearest(_matrix(b, "qvec", shared.value.shape[1]), shared.value, n).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(got) + 1, dtype=np.int32) * n), pa.array(got.ravel()))
                yield pa.RecordBatch.from_arrays([*b.columns, lists], ["query_id", "qvec", "lists"])

        return q.mapInArrow(run, "query_id long, qvec array<double>, lists array<int>")

    def probed(self, queries: DataFrame, query_id: str, query_vec: str) -> DataFrame:
        """query_id, qvec, list: a row for each list that a query reads."""
        return self.asked(queries, query_id, query_vec).select("query_id", "qvec", F.explode(F.col("lists").cast("array<long>")).alias("list"))

    def topk(self, queries: DataFrame, query_id: str, query_vec: str, k: int, max_queries: int = vectors.MAX_QUERIES) -> DataFrame:
        """Best k of the rows in the probed lists: (query_id, item_id, score, rn)."""
        most = min(max_queries, MOST_ASKED // self.probes)
        rows = self.asked(queries, query_id, query_vec).limit(most + 1).toArrow()  # one row a query, its vector once
        schema = "query_id long, item_id long, score double"
        if not rows.num_rows:
            return queries.sparkSession.createDataFrame([], schema + ", rn int")
        cand = self._shipped(rows, k, schema) if rows.num_rows <= most else self._met(self.probed(queries, query_id, query_vec), k, schema)
        w = W.partitionBy("query_id").orderBy(F.col("score").desc(), "item_id")
        return cand.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)

    def _shipped(self, rows: pa.Table, k: int, schema: str) -> DataFrame:
        """A bounded query set goes to the tasks; only the lists it names are read."""
        rows = rows.combine_chunks()
        qid = rows["query_id"].to_pylist()
        qm = vectors.unit_matrix(rows["qvec"].combine_chunks().flatten().to_numpy().reshape(len(qid), self.centroids.shape[1]))
        lists = rows["lists"].combine_chunks().flatten().to_numpy()
        order = np.argsort(lists, kind="stable")
        lists, who = lists[order], np.repeat(np.arange(len(qid), dtype=np.int32), len(lists) // len(qid))[order]
        shared = self.stored.sparkSession.sparkContext.broadcast((lists, who, qid, qm))

        def score(batches):
            lists, who, qid, qm = shared.value
            for b in batches:
                if not b.num_rows:
                    continue
                own, ids = b.column("list").to_numpy(), b.column("item_id").to_numpy()
                m = _matrix(b, "vec", qm.shape[1])
                for n in np.unique(own).tolist():
                    ask = who[np.searchsorted(lists, n):np.searchsorted(lists, n, "right")]
                    if len(ask):
                        some = own == n
                        out = vectors._candidates([qid[i] for i in ask], qm[ask], ids[some], m[some], k, None)
                        yield pa.RecordBatch.from_pandas(out, preserve_index=False)

        return self.stored.where(F.col("list").isin(np.unique(lists).tolist())).select("item_id", "vec", "list").mapInArrow(score, schema)

    def _met(self, probed: DataFrame, k: int, schema: str) -> DataFrame:
        """A large query set meets the lists, a long list in several blocks."""
        size = self.stored.groupBy("list").agg(F.ceil(F.count("list") / F.lit(BLOCK_ROWS)).cast("int").alias("blocks"))
        left = self.stored.join(size, "list").withColumn("block", F.pmod(F.xxhash64("item_id"), F.col("blocks").cast("long")).cast("int"))
        right = probed.join(size, "list").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))

        def score(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            if a.empty or b.empty:
                return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "item_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
            return vectors._candidates(b["query_id"].tolist(), vectors.unit_matrix(np.stack(b["qvec"])), a["item_id"].to_numpy(),
                                       vectors.unit_matrix(np.stack(a["vec"])), k, None)

        return left.select("list", "block", "item_id", "vec").groupBy("list", "block").cogroup(
            right.select("list", "block", "query_id", "qvec").groupBy("list", "block")).applyInPandas(score, schema)


def build(corpus: DataFrame, id_col: str, vec_col: str, path: str, k: int = 10, recall: float = 0.95, lists: int | None = None) -> IvfIndex:
    """Fit, assign, store under ``path`` and choose the probes for ``recall`` of the best ``k`` (set it above what other queries must reach).

    Null vectors are left out. Ids must be integers, and all vectors of one length.
    """
    spark = corpus.sparkSession
    c = corpus.where(F.col(vec_col).isNotNull()).select(F.col(id_col).cast("long").alias("item_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    n = c.count()
    few = c.orderBy(F.xxhash64("item_id"), "item_id").limit(SAMPLE).toPandas()
    if few.empty:
        c.withColumn("list", F.lit(0).cast("long")).write.parquet(path)
        return IvfIndex(spark.read.parquet(path), np.zeros((1, 1)), 1)
    m = vectors.unit_matrix(np.stack(few["vec"]))
    most = max(1, min(MOST_LISTS, MOST_BYTES // (8 * m.shape[1]), len(m)))
    lists = max(1, min(most, lists or round(2 * n ** 0.5)))
    centroids = fit(m, lists)
    shared = spark.sparkContext.broadcast(centroids)

    def assign(batches):
        for b in batches:
            if b.num_rows:
                own = nearest(_matrix(b, "vec", shared.value.shape[1]), shared.value)[:, 0]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own)], ["item_id", "vec", "list"])

    # in the order of lists, so that a scan skips the row groups of lists that no query names; a long list may take several tasks
    c.mapInArrow(assign, "item_id long, vec array<double>, list long").repartitionByRange("list", "item_id").sortWithinPartitions("list") \
        .write.option("parquet.block.size", 8 << 20).parquet(path)
    stored = spark.read.schema("item_id long, vec array<double>, list long").parquet(path)
    tested = spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(few["item_id"][-TESTED:], few["vec"][-TESTED:])], "query_id long, query_vec array<double>")
    exact = vectors.topk(stored, "item_id", "vec", tested, "query_id", "query_vec", k)
    where = exact.join(stored.select("item_id", "list"), "item_id").select("query_id", "list").toPandas()  # at most TESTED * k rows
    order = dict(zip(few["item_id"][-TESTED:], nearest(m[-TESTED:], centroids, lists)))
    place = {q: np.argsort(o, kind="stable") for q, o in order.items()}
    ranks = np.sort([place[q][x] for q, x in zip(where["query_id"], where["list"])])
    probes = int(ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))) - 1)]) + 1
    return IvfIndex(stored, centroids, probes)
