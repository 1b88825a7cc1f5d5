"""Rules that are easy to get wrong, on hand-made rows."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeloom.functions import dates
from lakeloom.functions.numbers import avg_if, count_if, pct, sum_if
from lakeloom.functions.text import fixed_windows, nonblank_line_count, strip_tags, tokens
from lakeloom.operators import aggregates, dml, evaluation, impact, joins, keyword, migration, quality, retrieval, sets, textjobs, topk
from lakeloom.operators.chunking import chunk_lines
from lakeloom.operators.semantic import Measure, Model, Relationship, infer_relationships, metric_query, read_model


def got(df, *cols):
    return sorted(tuple(r[c] for c in (cols or df.columns)) for r in df.collect())


def test_all_cancelled_group_has_sum_zero_and_null_mean(rows):
    df = rows("g string, status string, x int", ("a", "cancelled", 5), ("b", "ok", 7), ("b", "cancelled", 1))
    live = F.col("status") != "cancelled"
    out = df.groupBy("g").agg(sum_if(live, "x").alias("s"), avg_if(live, "x").alias("m"), count_if(live).alias("n"))
    assert got(out) == [("a", 0, None, 0), ("b", 7, 7.0, 1)]


def test_pct_of_zero_is_null(rows):
    df = rows("a int, b int", (1, 0), (1, 8))
    assert [r[0] for r in df.select(pct(F.col("a"), F.col("b"))).collect()] == [None, 12.5]


def test_month_ranges():
    assert dates.month_start(dt.date(2001, 1, 31), -1) == dt.date(2000, 12, 1)
    assert dates.month_start(dt.date(2001, 12, 5), 1) == dt.date(2002, 1, 1)


def test_month_filter_is_pushed_to_the_scan(spark):
    from lakeloom.plans.frames import Frames
    f = Frames(spark, "/root/testdata/sf0.001")
    plan = f.orders.where(dates.in_month("o_orderdate", f.as_of, -1)).select("o_orderkey") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert "o_totalprice" not in plan


def test_metric_query_joins_only_what_is_asked(spark, rows):
    tables = {"f": rows("k int, x int", (1, 2), (2, 3)), "d": rows("k int, color string", (1, "red"))}
    used = []

    def table(name):
        used.append(name)
        return tables[name]

    m = Model("f", {"s": Measure("s", "x", "sum")}, relationships=(Relationship("d", ("k",), ("color",)),))
    assert got(metric_query(m, table, ["s"])) == [(5,)] and used == ["f"]
    used.clear()
    out = metric_query(m, table, ["s"], ["color"])
    assert {(r["color"], r["s"]) for r in out.collect()} == {("red", 2), (None, 3)} and used == ["f", "d"]


def test_model_dialects():
    a = read_model({"tables": [
        {"name": "o", "columns": [{"name": "status"}], "time_dimensions": [{"column_name": "day"}],
         "measures": [{"name": "n", "expr": "COUNT(1)"}, {"name": "x", "expr": "x", "default_aggregation": "sum"}]},
        {"name": "c", "columns": [{"name": "id"}, {"name": "segment"}]}],
        "relationships": [{"left_table": "o", "right_table": "c", "join_type": "left_outer",
                           "relationship_columns": [{"left_column": "id", "right_column": "id"}]}]})
    assert a["o"].relationships[0].fields == ("segment",) and a["o"].relationships[0].how == "left"
    b = read_model({"tables": [{"name": "t", "dimensions": [{"name": "job", "expr": "ajs", "synonyms": ["batch"]}],
                                "facts": [{"name": "live", "expr": "x * 2"}],
                                "metrics": [{"name": "jobs", "expr": "COUNT(DISTINCT ajs)", "synonyms": ["job number"]}]}]})
    assert b["t"].synonyms == {"batch": "job", "job number": "jobs"} and b["t"].facts == {"live": "x * 2"}


def test_relationships_by_key_name(rows):
    t = {"orders": rows("o_custkey int", (1,)), "customer": rows("c_custkey int", (1,))}
    assert infer_relationships(t) == [("custkey", "orders", "customer")]


def test_many_to_many_join_is_refused(rows):
    a = rows("k int, x int", (1, 1), (1, 2))
    with pytest.raises(ValueError):
        joins.guarded_join(a, a.withColumnRenamed("x", "y"), ["k"])
    assert joins.guarded_join(a, rows("k int, y int", (1, 9)), ["k"]).count() == 2


def test_not_in_null_rules(rows):
    src = rows("k int", (1,), (2,), (None,))
    assert got(joins.not_in(src, rows("k int", (1,), (None,)), "k")) == []
    assert got(joins.not_in(src, rows("k int", (1,)), "k")) == [(2,)]
    assert joins.not_in(src, rows("k int"), "k").count() == 3
    assert joins.insert_missing(src, rows("k int", (1,), (None,)), "k").count() == 2


@pytest.mark.parametrize("inline", [500, 0])
def test_contains_join_keeps_copies_of_texts_and_patterns(rows, inline):
    texts = rows("i int, t string", *[(i, "the red ring") for i in range(30)], (99, "blue"))
    pats = rows("j int, p string", *[(j, "red") for j in range(20)], (50, "blue"), (51, ""))
    out = joins.contains_join(texts, "t", pats, "p", inline)
    assert got(out, "i", "j") == sorted([(i, j) for i in range(30) for j in range(20)] + [(99, 50)] + [(i, 51) for i in [*range(30), 99]])  # '' is in every text


@pytest.mark.parametrize("inline", [500, 0])
def test_contains_join_paths_agree_with_brute_force(rows, inline):
    texts = ["red ring on a plate", "a red r", "ringring", "", "plate", "xxred ringyy red ring"]
    pats = ["red ring", "ring", "plate", "absent", "a red r", "g", "on", "xxred ringyy red ring"]
    out = joins.contains_join(rows("i int, t string", *enumerate(texts)), "t", rows("p string", *[(p,) for p in pats]), "p", inline)
    want = sorted((i, p) for i, t in enumerate(texts) for p in pats if p in t)
    assert got(out, "i", "p") == want


def test_cross_grid_paths(rows, monkeypatch):
    base, axis = rows("y int", (1,), (2,)), rows("r string", ("a",), ("b",), ("c",))
    small = got(joins.cross_grid(base, {"m": [1, 2]}, {"r": axis}), "y", "m", "r")
    monkeypatch.setattr(joins, "small_rows", lambda df, cap=0: None)
    assert got(joins.cross_grid(base, {"m": [1, 2]}, {"r": axis}), "y", "m", "r") == small and len(small) == 12


def test_chunk_index_keeps_gaps(rows):
    out = chunk_lines(rows("d int, t string", (1, "first long line\nshort\n  third long line  "), (2, None)), ["d"], "t")
    assert got(out) == [(1, 0, "first long line"), (1, 2, "third long line")]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text(st.characters(codec="utf-8", exclude_categories=["Cs"], max_codepoint=0xFFFF), max_size=60),
       st.integers(2, 12), st.integers(0, 5))
def test_windows_rebuild_the_text(spark, text, size, overlap):
    overlap = min(overlap, size - 1)
    parts = spark.range(1).select(fixed_windows(F.lit(text), size, overlap).alias("w")).first()["w"]
    joined = parts[0]["chunk_text"] + "".join(p["chunk_text"][overlap:] for p in parts[1:])
    assert joined == text
    assert all(len(p["chunk_text"]) <= size for p in parts)


def test_text_helpers(spark):
    r = spark.range(1).select(tokens(F.lit("Été, l'ÉCOLE 42!")).alias("t"), nonblank_line_count(F.lit("a\n \t\nb")).alias("n"),
                              strip_tags(F.lit("<p>a<script>x</script>&amp;lt; <b>c</b></p>")).alias("h")).first()
    assert r["t"] == ["été", "l", "école", "42"] and r["n"] == 2 and r["h"] == "a &lt; c"


def test_ordered_text_of_nothing_is_null(rows):
    df = rows("r int, t string", (2, "b"), (1, "a"))
    agg = retrieval.ordered_text(F.col("t"), ["r"], ",")
    assert df.agg(agg).first()[0] == "a,b"
    assert df.where("r > 5").agg(agg).first()[0] is None


def test_search_filters(rows):
    df = rows("i int, a string, b string", (1, "x", "p"), (2, "y", "p"), (3, None, "p"), (4, "x", "q"))
    spec = '{"@and": [{"@or": [{"@eq": {"a": "x"}}, {"@eq": {"a": "y"}}]}, {"@eq": {"b": "p"}}]}'
    assert got(df.where(retrieval.filter_column(spec)), "i") == [(1,), (2,)]
    assert df.where(retrieval.filter_column(None)).count() == 4
    with pytest.raises(ValueError):
        retrieval.filter_column({"@not": {}})


def test_hidden_rows_take_no_part_in_scores(rows):
    docs = rows("id int, dep string, t string", (1, "a", "cat dog"), (2, "a", "cat"), (3, "b", "cat cat cat"))
    mapping = rows("user_name string, department string", ("u", "a"))
    q = rows("q int, x string", (1, "cat dog"))
    seen = retrieval.row_access(docs, "dep", mapping, "u")
    alone = keyword.bm25_topk(docs.where("dep = 'a'"), "id", "t", q, "q", "x", 5)
    assert got(keyword.bm25_topk(seen, "id", "t", q, "q", "x", 5)) == got(alone)
    assert retrieval.row_access(docs, "dep", mapping, "u", True).count() == 3


def test_bm25_by_hand(rows):
    import math
    texts = {1: "cat dog cat", 2: "dog", 3: "bird bird", 4: ""}
    out = keyword.bm25_topk(rows("id int, t string", *texts.items()), "id", "t", rows("q int, x string", (7, "Cat! dog"), (8, "none")), "q", "x", 5)
    n, avg = 4, 6 / 4

    def score(words):
        s = 0
        for w, df in (("cat", 1), ("dog", 2)):
            tf = words.count(w)
            s += math.log(1 + (n - df + .5) / (df + .5)) * tf * 2.2 / (tf + 1.2 * (.25 + .75 * len(words) / avg))
        return round(s, 4)

    assert got(out, "query_id", "doc_id", "score", "rn") == [(7, 1, score(["cat", "dog", "cat"]), 1), (7, 2, score(["dog"]), 2)]


def test_rrf_does_not_depend_on_input_order(rows):
    ddl = "query_id int, item_id int, score double, rn int"
    a, b = rows(ddl, (1, 1, .9, 1), (1, 2, .8, 2)), rows(ddl, (1, 2, 5., 1), (1, 3, 4., 2))
    one, two = keyword.rrf([("a", a), ("b", b)], 3), keyword.rrf([("b", b), ("a", a)], 3)
    assert got(one, "item_id", "final_score", "rn") == got(two, "item_id", "final_score", "rn")
    assert one.where("rn = 1").first()["item_id"] == 2


def test_macro_scores_and_empty_answer(rows):
    e = rows("c int, i int", (1, 1), (1, 2), (2, 5), (3, 9))
    r = rows("c int, i int", (1, 1), (2, 5))
    s = sets.case_scores(e, r, "c", "i")
    assert got(s, "c", "recall", "precision", "exact_match") == [(1, .5, 1.0, False), (2, 1.0, 1.0, True), (3, 0.0, 0.0, False)]
    m = sets.macro_scores(s).first()
    assert (m["mean_recall"], m["mean_precision"], m["exact_match_rate"]) == (.5, .6667, .3333)


def test_result_diff_counts_copies(rows):
    a, b = rows("x int", (1,), (1,), (2,)), rows("x int", (1,), (3,))
    r = sets.result_diff(a, b).first()
    assert (r["only_left"], r["only_right"], r["equal"]) == (2, 1, False)
    assert sets.result_diff(a, a).first()["equal"]


@pytest.mark.parametrize("p", [0.0, 0.5, 0.95, 1.0])
@pytest.mark.parametrize("n", [3, 20, 261, 3001, 90000])
def test_percentile_is_exact(spark, p, n):
    import numpy as np
    df = spark.range(n).select((F.col("id") % 3).alias("g"), F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(
        F.pmod(F.hash("id"), F.lit(100003)) / 7.0).alias("v"))
    out = {r["g"]: r["p"] for r in aggregates.exact_percentile(df, ["g"], "v", p, "p").collect()}
    data = df.toPandas()
    for g, v in data.groupby("g")["v"]:
        assert out[g] == pytest.approx(float(np.quantile(v, p)), abs=1e-9)


def test_apply_changes_twice_changes_nothing(rows):
    base = rows("k int, v int", (1, 10), (2, 20), (3, 30))
    ch = rows("k int, seq int, op string, v int", (1, 2, "U", 11), (1, 5, "D", 0), (2, 9, "U", 22), (4, 1, "I", 40), (1, 1, "U", 9))
    once = dml.apply_changes(base, ch, "k")
    assert got(once) == [(2, 22), (3, 30), (4, 40)]
    assert got(dml.apply_changes(once, ch, "k")) == got(once)


def test_fill_missing_only_where_source_has_text(rows):
    df = rows("s string, t string", (None, "code"), (None, ""), ("kept", "code"), (None, None))
    out = dml.fill_missing(df, "s", F.upper("t"), F.length("t") > 0)
    assert [r["s"] for r in out.collect()] == ["CODE", None, "kept", None]


def test_delete_cascade(rows):
    docs, ch = rows("d int, n string", (1, "a"), (2, "b"), (3, None)), rows("d int, c int", (1, 1), (1, 2), (2, 3))
    rest, kept, gone = dml.delete_cascade(docs, F.col("n") == "a", "d", ch)
    assert rest.count() == 2 and kept[0].count() == 1 and gone[0].count() == 2


def test_constraint_check(rows):
    df = rows("id int, p int, n string", (1, 1, "x"), (1, 9, None), (2, None, "y"))
    out = {(r[0], r[1]): r[2] for r in dml.constraint_check(df, ["id"], ["n"], {"p": (rows("pk int", (1,)), "pk")}).collect()}
    assert out == {("not_null", "n"): 1, ("primary_key", "id"): 1, ("foreign_key", "p"): 1}


def test_history_keeps_the_last_messages(rows):
    c = rows("c int, turn int, text string", *[(1, i, str(i)) for i in range(50)], (2, 0, "x"))
    out = {r["c"]: [m["turn"] for m in r["history"]] for r in topk.history_arrays(c, "c", "turn", ["text"], 20).collect()}
    assert out == {1: list(range(30, 50)), 2: [0]}


def test_subset_denominators(rows):
    df = rows("tool_type string, category string, is_correct boolean, relevance_score int, tool_match boolean, response_sec double",
              ("h", "A", True, 5, True, 1.0), ("h", "E", True, 3, True, 2.0), ("h", "C", False, 4, False, 3.0), ("h", "B", False, 1, True, 9.0))
    r = evaluation.eval_compare(df).first()
    assert (r["impact_accuracy_pct"], r["code_search_score"], r["tool_routing_accuracy_pct"]) == (25.0, 4.0, 25.0)


def test_reply_stream_stops_at_done(rows):
    d = 'data: {"type": "content_block_delta", "delta": {"type": "text_delta", "text": "%s"}}'
    lines = [": ping", d % "Hello ", "data: {bad", 'data: {"type": "tool_use", "name": "search"}', d % "you", "data: [DONE]", d % " never"]
    r = evaluation.answer_from_events(rows("k int, s int, l string", *[(1, i, x) for i, x in enumerate(lines)]), ["k"], "s", "l").first()
    assert r["answer"] == "Hello you" and r["used_tools"] == ["search"]


def test_crud_counts_rows_and_jobs(rows):
    df = rows("ajs_name string, table_name_jp string, crud_c_flag int, crud_r_flag int, crud_u_flag int, crud_d_flag int",
              ("j1", "t", 0, 1, 1, 0), ("j1", "t", 0, 1, 0, 0), ("j2", "t", 0, 0, 1, 0))
    r = impact.crud_summary(df).first()
    assert (r["read_rows"], r["read_jobs"], r["update_rows"], r["update_jobs"]) == (2, 1, 2, 2)


def test_impact_closure_stops_at_depth(rows):
    flags = "ajs_name string, table_name_jp string, crud_c_flag int, crud_r_flag int, crud_u_flag int, crud_d_flag int"
    chain = [(f"j{i}", f"t{i}", 0, 1, 0, 0) for i in range(5)] + [(f"j{i}", f"t{i + 1}", 0, 0, 1, 0) for i in range(5)]
    df = rows(flags, *chain)
    start = df.where("table_name_jp = 't0'")
    assert got(impact.impact_closure(df, start, 3)) == [(f"t{i}", i, False) for i in range(4)]
    assert got(impact.impact_closure(df, start)) == [(f"t{i}", i, True) for i in range(6)]


def test_routes(rows):
    q = rows("i int, t string", (1, "どのジョブが更新しますか"), (2, "処理内容を解説して"), (3, "更新エラーの原因"), (4, "hello"))
    assert got(impact.route(q, "t"), "i", "route") == [
        (1, "impact_analysis_tool"), (2, "source_code_search_tool"), (3, "both"), (4, "none")]


def test_rules_count_null_as_failure(rows):
    df = rows("x int", (1,), (-1,), (None,))
    r = quality.check_rules(df, [quality.Rule("pos", "x > 0", 2.0), quality.Rule("any", "TRUE", 1.0)])
    assert got(r, "rule", "passed", "failed") == [("any", 3, 0), ("pos", 1, 2)]
    assert quality.score(r).first()["score"] == round(100 - 2 * 66.67 / 3, 2)


def test_reconcile_rows(rows):
    a = rows("k int, v int, w string", (1, 1, "x"), (2, 2, None), (3, 3, "z"))
    b = rows("k int, v int, w string", (1, 1, "x"), (2, 9, None), (4, 4, "q"))
    assert got(migration.reconcile_rows(a, b, "k")) == [(2, "changed"), (3, "missing"), (4, "extra")]
    c = rows("k int, v string, w string", (1, "x", None), (2, "a", "b"), (2, "c", "d"), (None, "n", "n"))
    d = rows("k int, v string, w string", (1, None, "x"), (2, "c", "d"), (2, "a", "b"), (None, "n", "n"))
    assert got(migration.reconcile_rows(c, d, "k")) == [(1, "changed")]


def test_target_decision_cascade(rows):
    found = rows("feature_id string, db_name string, object_name string", ("2-1", "m", "o"), ("3-2", "v", "o"), ("2-1", "v", "o"))
    ans = rows("db_name string, oltp boolean, read_only boolean, big_or_rare boolean",
               ("v", False, True, True), ("m", False, True, True), ("o", True, False, False), ("s", False, True, True), ("d", False, True, False))
    assert got(migration.target_decision(found, ans), "db_name", "target") == [
        ("d", "SQL DB Serverless"), ("m", "SQL MI"), ("o", "SQL DB Serverless"), ("s", "Synapse + ADLS"), ("v", "SQL on VM")]


def test_integer_division(spark):
    assert spark.sql("SELECT 5000 * 8 div 1024 div 1024, 5000 * 8 div 1024").first()[:] == (0, 39)


def test_split_is_disjoint(rows):
    from lakeloom.plans.search import disjoint_split
    df = rows("k string", *[(str(i),) for i in range(100)])
    out = got(disjoint_split(df, "k", 20).groupBy("split").count())
    assert out == [("train", 80), ("validation", 20)]


def test_japanese_words_and_synonyms(rows):
    from lakeloom.functions.text import tokens
    from lakeloom.operators.keyword import bm25_topk
    docs = rows("d long, t string", (1, "エラー処理の実装 in Python"), (2, "plain English text"), (3, "売上の集計"))
    assert docs.select(tokens("t").alias("w")).first()["w"][:3] == ["エラ", "ラー", "ー処"]
    hits = bm25_topk(docs, "d", "t", rows("q long, t string", (7, "エラー処理の実装方法")), "q", "t", 2)
    assert [r["d"] if "d" in r else r["doc_id"] for r in hits.select("d" if "d" in hits.columns else "doc_id").collect()] == [1]
    terms = rows("term string, target string", ("使用しているジョブ", "crud_r_flag = 1"))
    q = rows("i int, t string", (1, "T_7を使用しているジョブを教えて"), (2, "なし"))
    from lakeloom.operators.semantic import resolve_terms
    assert got(resolve_terms(q, "t", "i", terms)) == [(1, "使用しているジョブ", "crud_r_flag = 1")]


@pytest.mark.parametrize("batch", [1, 3, 10_000])
def test_summaries_move_texts_only(spark, rows, batch):
    texts = [(1, "One cat. A cat sat! The dog.\nCat cat cat"), (2, "b a. a"), (2, "c c c. b b b. a"), (3, "..."), (4, None), (5, ""), (None, "x y. x"),
             (6, "same words here. same words here. same words here")]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = textjobs.summarize(rows("id long, t string", *texts), "id", "t", 2)
        assert sorted(tuple(r) for r in got.collect()) == [
            (1, "One cat / Cat cat cat"), (2, "b a / a"), (2, "c c c / b b b"), (6, "same words here / same words here")]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Window" not in plan  # words and sentences are no rows to group
