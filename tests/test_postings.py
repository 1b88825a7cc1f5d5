"""The keyword index on disk against a search that cuts all texts again."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeloom.operators.keyword import DOC_MARK, bm25_topk
from lakeloom.operators.postings import KeywordIndex, file_state, postings_of
from lakeloom.session import shared_dir

DOCS = [(1, "a cat and a dog", "v1"), (2, "the dog", "v1"), (3, "cat cat cat", "v1"), (4, None, "v1"), (5, "", None), (6, "エラー処理の方法 cat", "v1")]
QUERIES = ((7, "Cat! dog"), (8, "none of these"), (9, "エラー処理"), (10, None), (11, "dog dog the"))


def frame(rows, docs):
    return rows("doc_id long, text string, version string", *docs)


def asked(rows):
    return rows("q int, x string", *QUERIES)


def got(df):
    return sorted((r.query_id, r.doc_id, r.score, r.rn) for r in df.collect())


def same(rows, index, docs, among=None):
    d = frame(rows, docs)
    want = bm25_topk(d if among is None else d.join(among, "doc_id", "left_semi"), "doc_id", "text", asked(rows), "q", "x", 3)
    assert got(index.topk(asked(rows), "q", "x", 3, among)) == got(want)


def test_refresh_by_document(spark, rows, monkeypatch):
    index = KeywordIndex(spark, shared_dir(spark, "test-index"), buckets=4).refresh(frame(rows, DOCS))
    same(rows, index, DOCS)
    later = [(1, "a cat and a dog", "v1"), (2, "the old dog sleeps", "v2"), (3, "cat cat cat", "v1"), (5, "", None), (6, "dog", "v2"), (12, "a new dog", "v1")]
    index.refresh(frame(rows, later))  # 4 leaves, 2 and 6 change, 12 is new
    same(rows, index, later)
    assert {(r.doc_id, r.gen) for r in index.documents().collect()} == {(1, 1), (2, 2), (3, 1), (5, 1), (6, 2), (12, 2)}
    second = spark.read.parquet(f"{index.root}/postings/gen=2")
    assert {r.doc_id for r in second.select("doc_id").distinct().collect()} == {2, 6, 12}  # nothing else was cut or written
    index.refresh(frame(rows, later))
    assert spark.read.schema("doc_id long").parquet(f"{index.root}/postings/gen=3").count() == 0
    index.refresh(frame(rows, [(3, "no longer a feline", "v9")]), gone=False)  # only news
    after = [x for x in later if x[0] != 3] + [(3, "no longer a feline", "v9")]
    same(rows, index, after)
    same(rows, index, after, rows("doc_id long", (2,), (3,), (12,)))
    again = KeywordIndex(spark, index.root, buckets=4).open()
    assert (again.n, again.words, again.generation) == (index.n, index.words, 4)
    same(rows, again, after)
    whole = index.compact(shared_dir(spark, "test-index"))
    same(rows, whole, after)
    assert whole.generation == 1
    monkeypatch.setattr("lakeloom.operators.postings.MOST_TERMS", 0)  # postings are shuffled to the words
    same(rows, whole, after)
    index.refresh(frame(rows, []))
    assert index.n == 0 and got(index.topk(asked(rows), "q", "x", 3)) == []


def test_empty_index(spark, rows):
    index = KeywordIndex(spark, shared_dir(spark, "test-index")).refresh(frame(rows, []))
    assert got(index.topk(asked(rows), "q", "x", 3)) == []


def test_search_reads_few_partitions(spark, rows):
    index = KeywordIndex(spark, shared_dir(spark, "test-index")).refresh(frame(rows, DOCS))
    plan = index.topk(rows("q int, x string", (1, "cat")), "q", "x", 3)._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1][:200]


def test_best_are_found_in_the_tasks(spark, rows, monkeypatch):
    """Pairs of query and document never become rows, also where every document holds the words of every query."""
    monkeypatch.setattr("lakeloom.operators.postings.MOST_ADDED", 40)  # several rounds a batch, and the best cut on the way
    monkeypatch.setattr("lakeloom.operators.postings.KEPT", 1)
    docs = [(i, "the cat " * (1 + i % 7) + f"w{i % 5}", "v1") for i in range(300)]
    queries = rows("q int, x string", *((i, f"the cat w{i % 5}") for i in range(20)), (None, "w3"))
    index = KeywordIndex(spark, shared_dir(spark, "test-index")).refresh(frame(rows, docs))
    hits = index.topk(queries, "q", "x", 3)
    order = lambda df: sorted((str(r.query_id), r.rn, str(r.doc_id), r.score) for r in df.collect())
    assert order(hits) == order(bm25_topk(frame(rows, docs), "doc_id", "text", queries, "q", "x", 3))
    assert "HashAggregate(keys=[query_id" not in hits._jdf.queryExecution().executedPlan().toString()
    among = rows("doc_id long", *((i,) for i in range(0, 300, 3)))
    few = order(index.topk(queries, "q", "x", 3, among))
    monkeypatch.setattr("lakeloom.operators.postings.MOST_AMONG", 9)  # postings are shuffled to the filter
    assert few == order(index.topk(queries, "q", "x", 3, among)) == order(
        bm25_topk(frame(rows, docs).join(among, "doc_id", "left_semi"), "doc_id", "text", queries, "q", "x", 3))


def test_file_state(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(3).write.parquet(path)
    one = file_state(spark.read.parquet(path))
    assert one == file_state(spark.read.parquet(path))
    spark.range(3).write.mode("append").parquet(path)
    assert file_state(spark.read.parquet(path)) != one
    assert isinstance(F.lit(1), object)


@pytest.mark.parametrize("size", [1, 2, 3, 20])
def test_words_are_counted_in_the_tasks_whatever_the_batches(size):
    rows = [(None, "v1", "a b a"), (None, "v2", "b"), (1, "v1", "x"), (2, "v1", "a a b"), (2, "v3", "a c c c d"), (2, "v2", "a"), (3, "v1", "")]
    t = pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "version": [r[1] for r in rows],
                  "words": pa.array([[*r[2].split(), DOC_MARK] for r in rows], pa.list_(pa.string()))})
    out = [r for b in postings_of(t.to_batches(max_chunksize=size)) for r in b.to_pylist()]
    want = [(None, "a", 2, 3, None), (None, "b", 2, 3, None), (None, "", 2, 3, "v2"), (1, "x", 1, 1, None), (1, "", 1, 1, "v1"),
            (2, "a", 4, 5, None), (2, "b", 1, 3, None), (2, "c", 3, 5, None), (2, "d", 1, 5, None), (2, "", 3, 5, "v3"), (3, "", 1, 0, "v1")]
    assert sorted((tuple(r.values()) for r in out), key=str) == sorted(want, key=str)
