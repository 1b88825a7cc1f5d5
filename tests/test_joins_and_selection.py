"""Fan-out-safe metrics, distributed selection, set-similarity matches, the inverted-file index: against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.operators import aggregates, ivf, semantic, similarity, vectors
from lakeloom.operators.semantic import Measure, Model, Relationship
from lakeloom.session import shared_dir

SALES = Model("sales", {m.name: m for m in (Measure("total", "sum(amount)"), Measure("n", "id", "count"), Measure("buyers", "cust", "count_distinct"),
                                            Measure("mean", "avg(amount)"))},
              relationships=(Relationship("customers", ("cust",), ("segment", "city")), Relationship("products", ("prod",), ("category",))),
              time_dimensions=("day",))
TARGETS = Model("targets", {"target": Measure("target", "sum(goal)")})


@pytest.fixture()
def tables(rows):
    made = {
        "sales": rows("id int, cust int, prod int, amount int, day date", (1, 1, 1, 10, None), (2, 1, 2, 20, None), (3, 2, 1, 40, None), (4, 3, 9, 80, None)),
        # customer 1 is held twice, and customer 2 in two segments
        "customers": rows("cust int, segment string, city string", (1, "a", "x"), (1, "a", "y"), (2, "a", "x"), (2, "b", "x")),
        "products": rows("prod int, category string", (1, "p"), (1, "p"), (2, "q")),
        "targets": rows("category string, goal int", ("p", 5), ("p", 6), ("z", 7)),
    }
    return made.__getitem__


def asked(tables, measures, dims=(), filters=(), model=SALES):
    return sorted((tuple(r) for r in semantic.metric_query(model, tables, list(measures), list(dims), None, list(filters)).collect()), key=repr)


def test_repeated_dimension_rows_do_not_multiply(tables):
    assert asked(tables, ["total", "n"], ["segment"]) == sorted([("a", 70, 3), ("b", 40, 1), (None, 80, 1)], key=repr)
    assert asked(tables, ["total", "n", "buyers", "mean"], ["category"]) == sorted([("p", 50, 2, 2, 25.0), ("q", 20, 1, 1, 20.0), (None, 80, 1, 1, 80.0)], key=repr)
    assert asked(tables, ["total"], ["segment", "category"]) == sorted([("a", "p", 50), ("a", "q", 20), ("b", "p", 40), (None, None, 80)], key=repr)
    assert asked(tables, ["total"]) == [(150,)]


def test_filters_on_any_table(tables):
    assert asked(tables, ["total"], [], ["segment in ('a', 'b')"]) == [(70,)]  # customer 2 counts once
    assert asked(tables, ["total"], [], [F.col("segment") == "b"]) == [(40,)]  # a column, and a field that is no dimension
    assert asked(tables, ["total"], ["category"], [F.col("city") == "x", "amount > 10"]) == [("p", 40), ("q", 20)]
    assert asked(tables, ["total"], ["segment"], ["segment = 'a'"]) == [("a", 70)]
    assert asked(tables, ["total"], [], ["segment is null"]) == [(80,)]
    assert asked(tables, ["total"], [], ["segment = 'a' or category = 'p'"]) == [(70,)]  # over two dimensions
    assert asked(tables, ["total"], ["segment"], ["city = 'x' or amount = 20"]) == [("a", 70), ("b", 40)]
    with pytest.raises(ValueError):
        asked(tables, ["total"], [], ["no_such_field = 1"])


def test_metrics_across_facts(tables):
    got = semantic.metrics_across([(SALES, ["total"]), (TARGETS, ["target"])], tables, ["category"]).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted([("p", 50, 11), ("q", 20, None), (None, 80, None), ("z", None, 7)], key=repr)


def test_synonyms_by_word(rows):
    texts = rows("id int, t string", (1, "wholesales by unitemized"), (2, "Sales, by ITEM!"), (3, "このテーブルを使用しているジョブ"), (4, "top sales   region"), (5, None))
    terms = rows("term string, target string", ("sales", "s"), ("Item", "i"), ("使用している", "u"), ("sales region", "sr"), ("", "none"))
    got = {(r.id, r.target) for r in semantic.resolve_terms(texts, "t", "id", terms).collect()}
    assert got == {(2, "s"), (2, "i"), (3, "u"), (4, "s"), (4, "sr")}


# --- selection ------------------------------------------------------------------------------------------

def quantile(values, p):
    v = sorted(values)
    pos = p * (len(v) - 1)
    return v[math.floor(pos)] + (pos - math.floor(pos)) * (v[math.ceil(pos)] - v[math.floor(pos)])


@pytest.mark.parametrize("p", [0.0, 0.95])
def test_percentile_by_rounds(spark, p):
    rng = np.random.default_rng(4)
    groups = {"normal": rng.normal(size=3000), "tied": np.repeat([1.0, 2.0, 3.0], [1500, 10, 1490]), "wide": 10.0 ** rng.uniform(-300, 300, 2000),
              "one": np.array([7.0]), "two": np.array([1.0, 2.0]), "equal": np.full(500, 4.0), None: rng.integers(0, 50, 900).astype(float)}
    data = [(g, float(v)) for g, x in groups.items() for v in x] + [("normal", None), ("empty", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(5)
    got = {r.g: r.p for r in aggregates.exact_percentile(df, ["g"], "v", p, "p", band=40).collect()}
    assert got == {g: pytest.approx(quantile(x.tolist(), p), rel=1e-12) for g, x in groups.items()}
    if not p:
        return
    whole = [v for _, v in data if v is not None]
    assert aggregates.exact_percentile(df, [], "v", p, "p", band=40).first().p == pytest.approx(quantile(whole, p), rel=1e-12)


def test_percentile_of_nothing(rows):
    df = rows("g string, v double", ("a", None))
    assert aggregates.exact_percentile(df, ["g"], "v", 0.5, "p").collect() == []
    assert aggregates.exact_percentile(df, [], "v", 0.5, "p").collect() == []


# --- set similarity -------------------------------------------------------------------------------------

def sets(seed, n, vocabulary=60, most=14):
    rng = np.random.default_rng(seed)
    p = 1 / np.arange(1, vocabulary + 1)
    return [sorted({f"w{i}" for i in rng.choice(vocabulary, rng.integers(0, most), p=p / p.sum())}) for _ in range(n)]


def jaccard(a, b):
    return len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 0.0


@pytest.mark.parametrize("threshold", [0.05, 0.4])
def test_best_match_is_the_best_of_all(spark, threshold):
    left, right = sets(1, 120) + [["only", "here"]], sets(2, 60)
    q = spark.createDataFrame([(i // 10, i % 10, x) for i, x in enumerate(left)], "c long, t long, x array<string>")
    s = spark.createDataFrame([(i, x) for i, x in enumerate(right)], "id long, y array<string>")
    got = {(r.c, r.t): (r.score, r.stored_id) for r in similarity.best_match(q, ["c", "t"], F.col("x"), s, "id", F.col("y"), threshold).collect()}
    for i, x in enumerate(left):
        score, neg = max((round(jaccard(x, y), 6), -j) for j, y in enumerate(right))
        assert got[i // 10, i % 10] == (score, -neg if score >= threshold else None), x


@pytest.mark.parametrize("t", [0.2, 0.5, 0.8])
def test_candidates_lose_no_pair(spark, t):
    left, right = sets(3, 80), sets(4, 80)
    q = spark.createDataFrame([(i, x) for i, x in enumerate(left)], "q long, words array<string>")
    s = spark.createDataFrame([(i, x) for i, x in enumerate(right)], "s long, words array<string>")
    df = similarity.rarity(q, s)
    got = {tuple(r) for r in similarity.candidates(similarity.ordered(q, ["q"], df), ["q"], similarity.ordered(s, ["s"], df), ["s"], t).collect()}
    want = {(i, j) for i, x in enumerate(left) for j, y in enumerate(right) if x and y and jaccard(x, y) >= t}
    share = {(i, j) for i, x in enumerate(left) for j, y in enumerate(right) if set(x) & set(y)}
    assert want <= got < share


# --- inverted-file index --------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(9)
    centers = rng.normal(size=(30, 16))
    x = centers[rng.integers(0, 30, 3000)] + 0.5 * rng.normal(size=(3000, 16))
    return spark.createDataFrame([(i, [float(y) for y in v]) for i, v in enumerate(x)] + [(9999, None)], "id long, v array<float>")


def test_ivf_recall_and_share(spark, clustered):
    index = ivf.build(clustered, "id", "v", shared_dir(spark, "test-ivf"))
    q = clustered.where("id % 50 = 0").select(F.col("id").alias("q"), F.col("v").alias("qv"))
    exact = vectors.topk(clustered, "id", "v", q, "q", "qv", 10)
    got = index.topk(q, "q", "qv", 10)
    assert vectors.recall_at_k(exact, got).agg(F.avg("recall")).first()[0] >= 0.9
    assert index.share_read(q, "q", "qv").agg(F.avg("read")).first()[0] < 0.3 * 3000
    assert index.stored.count() == 3000 and len(index.centroids) == round(2 * 3000 ** 0.5)
    scores = {(r.query_id, r.item_id): r.score for r in exact.collect()}
    for r in got.collect():  # scores are exact, and in order
        assert scores.get((r.query_id, r.item_id), r.score) == r.score
    plan = got._jdf.queryExecution().toString()
    assert "PushedFilters: [In(list" in plan or "PushedFilters: [IsNotNull(list)" in plan or "list" in plan


def test_ivf_large_query_set(spark, clustered, monkeypatch):
    index = ivf.build(clustered, "id", "v", shared_dir(spark, "test-ivf"), lists=20)
    q = clustered.where("id % 50 = 0").select(F.col("id").alias("q"), F.col("v").alias("qv"))
    monkeypatch.setattr(ivf, "BLOCK_ROWS", 50)  # lists are cut into blocks
    one, two = (sorted(tuple(r) for r in index.topk(q, "q", "qv", 5, most).collect()) for most in (10_000, 3))
    assert one == two and len(one) == 60 * 5
    index.probes = 20  # all lists: the exact answer
    assert sorted(tuple(r) for r in index.topk(q, "q", "qv", 5).collect()) == sorted(tuple(r) for r in vectors.topk(clustered, "id", "v", q, "q", "qv", 5).collect())


def test_ivf_brings_a_query_to_the_driver_once(spark, clustered, monkeypatch):
    index = ivf.build(clustered, "id", "v", shared_dir(spark, "test-ivf"), lists=20)
    index.probes, seen = 12, []
    shipped = ivf.IvfIndex._shipped
    monkeypatch.setattr(ivf.IvfIndex, "_shipped", lambda self, rows, k, schema: seen.append(len(rows)) or shipped(self, rows, k, schema))
    q = clustered.where("id % 50 = 0").select(F.col("id").alias("q"), F.col("v").alias("qv"))
    one = sorted(tuple(r) for r in index.topk(q, "q", "qv", 5).collect())
    assert seen == [60]  # not a row for each of the lists it reads
    monkeypatch.setattr(ivf, "MOST_ASKED", 100)  # 60 queries of 12 lists are too many to travel
    assert sorted(tuple(r) for r in index.topk(q, "q", "qv", 5).collect()) == one and seen == [60]


def test_ivf_of_little(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0])], "id long, v array<double>")
    index = ivf.build(df, "id", "v", shared_dir(spark, "test-ivf"))
    index.probes = len(index.centroids)
    assert [r.item_id for r in index.topk(df.where("id = 1"), "id", "v", 2).orderBy("rn").collect()] == [1, 2]
    none = ivf.build(df.where("id > 9"), "id", "v", shared_dir(spark, "test-ivf"))
    assert none.topk(df.where("id > 9"), "id", "v", 2).collect() == []
