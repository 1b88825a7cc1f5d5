"""Vector search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.functions.vectors import cosine
from lakeloom.operators import textjobs, vectors
from lakeloom.operators.encoders import embed_hashing, embed_with


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    centers = rng.standard_normal((8, 16)) * 4
    m = np.concatenate([c + rng.standard_normal((40, 16)) for c in centers]).astype(np.float32)
    m[5] = m[4]  # an exact copy: the lower id must come first
    rows = [(i, [float(x) for x in v], i // 40) for i, v in enumerate(m)]
    return spark.createDataFrame(rows, "id long, vec array<float>, label int").repartition(4), m.astype(np.float64)


def brute(m, q, k, thr=None):
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    out = set()
    for j in q:
        s = np.round(u @ u[j], 6)
        order = np.lexsort((np.arange(len(s)), -s))[:k]
        out |= {(j, int(i), rank + 1) for rank, i in enumerate(order) if thr is None or s[i] >= thr}
    return out


def ids(df):
    return {(r["query_id"], r["item_id"], r["rn"]) for r in df.collect()}


@pytest.mark.parametrize("limit", [4096, 3])
@pytest.mark.parametrize("thr", [None, 0.9])
def test_topk_paths_agree_with_brute_force(data, limit, thr):
    df, m = data
    q = df.where("id % 40 = 4").select(F.col("id").alias("qid"), F.col("vec").alias("qv"))
    out = vectors.topk(df, "id", "vec", q, "qid", "qv", 7, thr, max_queries=limit, block_rows=50)
    assert ids(out) == brute(m, range(4, 320, 40), 7, thr)


def test_pair_quality_over_blocks(data):
    df, m = data
    out = {r["pair_type"]: r for r in vectors.pair_quality(df, "id", "vec", "label", block_rows=37).collect()}
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    s, lab = np.round(u @ u.T, 6), np.arange(len(m)) // 40
    i, j = np.triu_indices(len(m), 1)
    for name, mask in (("same", lab[i] == lab[j]), ("other", lab[i] != lab[j])):
        v = s[i, j][mask]
        r = out[name]
        assert r["pairs"] == len(v)
        assert (r["avg_similarity"], r["min_similarity"], r["max_similarity"]) == pytest.approx((v.mean(), v.min(), v.max()), abs=1e-4)
    assert out["same"]["avg_similarity"] > out["other"]["avg_similarity"]


@pytest.mark.parametrize("limit", [4096, 3])
def test_score_stats(data, limit):
    df, m = data
    q = df.where("id < 8").select(F.col("id").alias("qid"), F.col("vec").alias("qv"))
    out = vectors.score_stats(df, "vec", q, "qid", "qv", 0.5, limit).collect()
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    assert len(out) == 8
    for r in out:
        s = np.round(u @ u[r["query_id"]], 6)
        assert (r["n_scored"], r["n_above"]) == (len(m), (s >= .5).sum())
        assert r["mean_score"] == pytest.approx(s.mean(), abs=1e-4)


def test_lsh_recall_on_clusters(data):
    df, _ = data
    q = df.where("id % 40 = 1").select(F.col("id").alias("qid"), F.col("vec").alias("qv"))
    args = (df, "id", "vec", q, "qid", "qv", 10)
    recall = vectors.recall_at_k(vectors.topk(*args), vectors.lsh_topk(*args, dim=16, bits=6))
    assert recall.agg(F.avg("recall")).first()[0] > 0.9


def test_first_pairs_are_the_first_of_all_pairs(data):
    df, _ = data
    small = df.where("id < 6")
    want = [(a, b) for a in range(6) for b in range(a + 1, 6)]
    for n in (3, 9, 50):
        got = [(r["a_id"], r["b_id"]) for r in vectors.first_pairs(small, "id", ["label"], n).collect()]
        assert got == want[:n]


def test_cosine_is_symmetric_and_one_with_itself(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0, -1.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    r = df.select(cosine("a", "b").alias("ab"), cosine("b", "a").alias("ba"), cosine("a", "a").alias("aa")).collect()
    assert r[0]["ab"] == pytest.approx(r[0]["ba"]) and r[0]["aa"] == pytest.approx(1.0)
    assert r[1]["ab"] is None


def test_nearest_centroid_paths(data, monkeypatch):
    df, _ = data
    cents = textjobs.centroids(df, "label", "vec")
    a = {(r["item_id"], r["label"]) for r in textjobs.assign_nearest(df, "id", "vec", cents).collect()}
    assert len(a) == 320 and sum(i // 40 == x for i, x in a) > 310
    b = {(r["item_id"], r["label"]) for r in textjobs.assign_nearest(df, "id", "vec", cents, cap=2).collect()}
    assert a == b


def test_encoders(spark):
    df = spark.createDataFrame([(1, "cat dog"), (2, "Dog, CAT"), (3, ""), (4, None)], "i int, t string")
    v = {r["i"]: r for r in embed_hashing(df, ["i"], "t", 32).collect()}
    assert list(v[1]["vec"]) == list(v[2]["vec"]) and abs(np.linalg.norm(v[1]["vec"]) - 1) < 1e-5
    assert v[3]["n_tokens"] == 0 and v[4]["n_tokens"] == 0 and not any(v[4]["vec"])
    w = {r["i"]: list(r["vec"]) for r in embed_with(df, ["i"], "t", lambda texts: [[len(t), 1.0] for t in texts]).collect()}
    assert w[1] == [7.0, 1.0] and w[4] == [0.0, 1.0]


def test_small_slices_of_a_batch(spark, monkeypatch):
    """Vectors are made and scored a few at a time; hits are those of whole batches, and a batch gives k rows a query."""
    from lakeloom.operators import encoders, vectors
    df = spark.createDataFrame([(i, " ".join(f"w{(i * j) % 23}" for j in range(1, 9))) for i in range(200)], "i long, t string")

    def run():
        v = encoders.embed_hashing(df, ["i"], "t", 32)
        hits = vectors.topk(v, "i", "vec", v.where("i % 50 = 0").withColumnRenamed("i", "q").withColumnRenamed("vec", "qv"), "q", "qv", 4)
        return sorted((r.i, r.n_tokens, tuple(r.vec)) for r in v.collect()), sorted(tuple(r) for r in hits.collect())

    whole = run()
    monkeypatch.setattr(encoders, "MOST_CELLS", 100)
    monkeypatch.setattr(vectors, "MOST_CELLS", 100)
    assert run() == whole
