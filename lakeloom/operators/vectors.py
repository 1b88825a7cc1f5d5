"""Exact and bucketed nearest neighbours by cosine similarity.

Vectors are scored in Arrow batches as a matrix product, and each task keeps only its best k rows
per query before anything is shuffled. Query sets up to ``MAX_QUERIES`` rows (checked) are shipped
to the tasks; larger ones meet the corpus in a grid of bounded blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeloom.functions.numbers import exact_avg
from lakeloom.functions.vectors import normalized
from lakeloom.operators.joins import small_rows

MAX_QUERIES = 4096
BLOCK_ROWS = 20_000
MOST_CELLS = 1 << 20  # numbers of vectors, or scores, that a task holds at a time, whatever the size of an Arrow batch
DIGITS = 6  # scores are rounded before ranking, so equal vectors tie and the id decides


def unit_matrix(vectors) -> np.ndarray:
    """Rows scaled to length 1; a zero vector scores 0 with everything."""
    m = np.asarray(vectors, dtype=np.float64)
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(n == 0, 1.0, n)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best of one query: score descending, id ascending."""
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        cand = np.flatnonzero(scores >= cut)
    else:
        cand = np.arange(len(scores))
    return cand[np.lexsort((ids[cand], -scores[cand]))][:k]


def _candidates(qid: list, qm: np.ndarray, ids: np.ndarray, m: np.ndarray, k: int,
                threshold: float | None) -> pd.DataFrame:
    scores = np.round(m @ qm.T, DIGITS)
    q_out, i_out, s_out = [], [], []
    for j, q in enumerate(qid):
        col = scores[:, j]
        pos = _best(col, ids, k)
        if threshold is not None:
            pos = pos[col[pos] >= threshold]
        q_out.extend([q] * len(pos))
        i_out.extend(ids[pos].tolist())
        s_out.extend(col[pos].tolist())
    return pd.DataFrame({"query_id": q_out, "item_id": i_out, "score": s_out})


def topk(corpus: DataFrame, id_col: str, vec_col: str, queries: DataFrame, query_id: str, query_vec: str,
         k: int, threshold: float | None = None, max_queries: int = MAX_QUERIES,
         block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Best k corpus rows per query: (query_id, item_id, score, rn). Ids must be integers.

    ``threshold`` keeps scores >= threshold; as only the top k are ranked this equals filtering
    before the limit.
    """
    c = corpus.where(F.col(vec_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("item_id"), F.col(vec_col).alias("vec"))
    q = queries.where(F.col(query_vec).isNotNull()).select(
        F.col(query_id).cast("long").alias("query_id"), F.col(query_vec).alias("qvec"))
    schema = "query_id long, item_id long, score double"
    rows = small_rows(q, max_queries)
    if rows is not None and not rows:
        return corpus.sparkSession.createDataFrame([], schema + ", rn int")
    if rows is not None:
        qid = [r["query_id"] for r in rows]
        qm = unit_matrix([r["qvec"] for r in rows])

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            step = max(1, MOST_CELLS // max(qm.shape))
            for b in batches:
                found = []
                for part in (b.slice(a, step) for a in range(0, b.num_rows, step)):
                    ids = part.column("item_id").to_numpy(zero_copy_only=False)
                    flat = part.column("vec").flatten().to_numpy(zero_copy_only=False)
                    m = unit_matrix(flat.reshape(part.num_rows, qm.shape[1]))
                    found.append(_candidates(qid, qm, ids, m, k, threshold))
                found = [x for x in found if len(x)] or found[:1]
                if found:
                    best = pd.concat(found).sort_values(["query_id", "score", "item_id"], ascending=[True, False, True])
                    out = best.groupby("query_id", sort=False, dropna=False).head(k)
                    yield pa.RecordBatch.from_pandas(out, preserve_index=False)

        cand = c.mapInArrow(score, schema)
    else:
        cand = _blocked(c, q, k, threshold, max_queries, block_rows, schema)
    w = W.partitionBy("query_id").orderBy(F.col("score").desc(), "item_id")
    return cand.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)


def score_stats(corpus: DataFrame, vec_col: str, queries: DataFrame, query_id: str, query_vec: str,
                threshold: float, max_queries: int = MAX_QUERIES) -> DataFrame:
    """Every query against every corpus row, reduced in the tasks to one line per query and batch.

    Returns rows scored, rows at or above the threshold, mean and best score of each query. The
    scores themselves are never written out. A query set above ``max_queries`` is cut into
    blocks of at most that many rows, one pass over the corpus per block.
    """
    c = corpus.where(F.col(vec_col).isNotNull()).select(F.col(vec_col).alias("vec"))
    q = queries.where(F.col(query_vec).isNotNull()).select(
        F.col(query_id).cast("long").alias("query_id"), F.col(query_vec).alias("qvec"))
    schema = "query_id long, n long, n_above long, total double, best double"

    def scorer(qid: list, qm: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    flat = b.column("vec").flatten().to_numpy(zero_copy_only=False)
                    s = np.round(unit_matrix(flat.reshape(b.num_rows, qm.shape[1])) @ qm.T, DIGITS)
                    yield pa.RecordBatch.from_pydict({
                        "query_id": pa.array(qid, pa.int64()),
                        "n": pa.array([len(s)] * len(qid), pa.int64()),
                        "n_above": pa.array((s >= threshold).sum(axis=0), pa.int64()),
                        "total": pa.array(s.sum(axis=0)), "best": pa.array(s.max(axis=0))})
        return run

    parts, last = None, None
    while True:  # one turn for a normal query set
        block = q if last is None else q.where(F.col("query_id") > last)
        rows = block.orderBy("query_id").limit(max_queries).collect()
        if not rows:
            break
        one = c.mapInArrow(scorer([r["query_id"] for r in rows], unit_matrix([r["qvec"] for r in rows])), schema)
        parts = one if parts is None else parts.unionByName(one)
        last = rows[-1]["query_id"]
        if len(rows) < max_queries:
            break
    if parts is None:
        parts = corpus.sparkSession.createDataFrame([], schema)
    return parts.groupBy("query_id").agg(
        F.sum("n").alias("n_scored"), F.sum("n_above").alias("n_above"),
        F.round(F.sum(F.col("total").cast("decimal(28,6)")).cast("double") / F.sum("n"), 4).alias("mean_score"),
        F.max("best").alias("best_score"))


def _blocked(c: DataFrame, q: DataFrame, k: int, threshold: float | None, max_queries: int,
             block_rows: int, schema: str) -> DataFrame:
    """Every query block meets every corpus block once; a block fits one task by construction."""
    n_c = max(1, -(-c.count() // block_rows))
    n_q = max(1, -(-q.count() // max_queries))
    cb = c.withColumn("cb", F.pmod(F.xxhash64("item_id"), F.lit(n_c))).withColumn(
        "qb", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))))
    qb = q.withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(n_q)).cast("int")).withColumn(
        "cb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_c - 1).cast("long"))))

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "item_id": pd.Series(dtype="int64"),
                                 "score": pd.Series(dtype="float64")})
        return _candidates(right["query_id"].tolist(), unit_matrix(np.stack(right["qvec"])),
                           left["item_id"].to_numpy(), unit_matrix(np.stack(left["vec"])), k, threshold)

    return cb.groupBy("cb", "qb").cogroup(qb.groupBy("cb", "qb")).applyInPandas(score, schema)


def first_pairs(df: DataFrame, id_col: str, cols: list[str], n: int) -> DataFrame:
    """First n pairs (a.id < b.id) in id order: an ordered sample of all pairs.

    The first n pairs only involve the n + 1 smallest ids, so the pairing never sees more rows.
    """
    few = df.select(id_col, *cols).orderBy(id_col).limit(n + 1).withColumn(
        "_r", F.row_number().over(W.orderBy(id_col)))
    a = few.select(*[F.col(c).alias(f"a_{c}") for c in (id_col, *cols)],
                   F.explode(F.sequence(F.col("_r") + 1, F.lit(n + 2))).alias("_r"))
    b = few.select("_r", *[F.col(c).alias(f"b_{c}") for c in (id_col, *cols)])
    return a.join(b, "_r").drop("_r").orderBy(f"a_{id_col}", f"b_{id_col}").limit(n)


def pair_quality(df: DataFrame, id_col: str, vec_col: str, group_col: str,
                 block_rows: int = 5_000) -> DataFrame:
    """Mean, min and max similarity over all pairs, same group against other group.

    Blocks of rows meet pairwise in a matrix product that returns four numbers per block pair;
    no pair is ever written out.
    """
    n = max(1, -(-df.count() // block_rows))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"),
                     F.hash(group_col).alias("g"), F.pmod(F.xxhash64(id_col), F.lit(n)).cast("int").alias("b"))
    left = rows.withColumn("o", F.explode(F.sequence(F.col("b"), F.lit(n - 1))))
    right = rows.withColumn("o", F.col("b")).withColumn("b", F.explode(F.sequence(F.lit(0), F.col("o"))))
    schema = "pair_type string, n long, total double, low double, high double"

    def stats(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(b):
            s = np.round(unit_matrix(np.stack(a["vec"])) @ unit_matrix(np.stack(b["vec"])).T, DIGITS)
            ia, ib = a["id"].to_numpy(), b["id"].to_numpy()
            diff_block = a["b"].iloc[0] != b["o"].iloc[0]
            keep = np.ones(s.shape, bool) if diff_block else ia[:, None] < ib[None, :]
            same = a["g"].to_numpy()[:, None] == b["g"].to_numpy()[None, :]
            for name, mask in (("same", keep & same), ("other", keep & ~same)):
                v = s[mask]
                if v.size:
                    out.append((name, v.size, float(v.sum()), float(v.min()), float(v.max())))
        return pd.DataFrame(out, columns=["pair_type", "n", "total", "low", "high"])

    parts = left.groupBy("b", "o").cogroup(right.groupBy("b", "o")).applyInPandas(stats, schema)
    return parts.groupBy("pair_type").agg(
        F.sum("n").alias("pairs"),
        F.round(F.sum(F.col("total").cast("decimal(28,6)")).cast("double") / F.sum("n"), 4).alias("avg_similarity"),
        F.round(F.min("low"), 4).alias("min_similarity"), F.round(F.max("high"), 4).alias("max_similarity"))


def lsh_topk(corpus: DataFrame, id_col: str, vec_col: str, queries: DataFrame, query_id: str, query_vec: str,
             k: int, dim: int, tables: int = 16, bits: int = 10, seed: int = 7) -> DataFrame:
    """Approximate top k: random-hyperplane buckets find candidates, an exact score ranks them.

    A query only meets rows that share a bucket with it in at least one of ``tables`` tables. The
    shuffle moves bucket keys and ids; hot buckets are split by AQE's skew join.
    """
    rng = np.random.default_rng(seed)
    planes = rng.standard_normal((dim, tables * bits))
    weights = 1 << np.arange(bits)

    @F.pandas_udf("array<long>")
    def buckets(v: pd.Series) -> pd.Series:
        if v.empty:
            return pd.Series([], dtype=object)
        side = (np.stack(v) @ planes > 0).reshape(len(v), tables, bits)
        return pd.Series(list(side.astype(np.int64) @ weights))

    def keyed(df, i, v, name):
        return df.where(F.col(v).isNotNull()).select(
            F.col(i).alias(name), F.posexplode(buckets(v)).alias("t", "bucket"))

    pairs = keyed(corpus, id_col, vec_col, "item_id").join(
        keyed(queries, query_id, query_vec, "query_id"), ["t", "bucket"]).select("query_id", "item_id").distinct()
    c = corpus.select(F.col(id_col).alias("item_id"), normalized(vec_col).alias("_u"))
    q = queries.select(F.col(query_id).alias("query_id"), normalized(query_vec).alias("_q"))
    dot = F.aggregate(F.zip_with("_u", "_q", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    scored = pairs.join(c, "item_id").join(q, "query_id").select(
        "query_id", "item_id", F.round(dot, DIGITS).alias("score"))
    w = W.partitionBy("query_id").orderBy(F.col("score").desc(), "item_id")
    return scored.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)


def recall_at_k(exact: DataFrame, approx: DataFrame) -> DataFrame:
    """Share of the exact neighbours found, per query."""
    hit = exact.select("query_id", "item_id").join(
        approx.select("query_id", "item_id", F.lit(1).alias("hit")), ["query_id", "item_id"], "left")
    return hit.groupBy("query_id").agg(exact_avg(F.coalesce("hit", F.lit(0))).alias("recall"))
