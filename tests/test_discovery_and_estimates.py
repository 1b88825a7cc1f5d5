"""Key discovery, profiles by day, sample estimates, draws and recent messages against brute force."""

import datetime as dt
import random
from bisect import bisect_left, bisect_right
from decimal import Decimal
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import sampling
from lakeloom.operators.dependencies import Dependencies
from lakeloom.operators.day_profiles import DayProfiles
from lakeloom.operators.generate import synthetic_orders
from lakeloom.operators.quality import Rule, exact_distinct
from lakeloom.streaming.recent import RecentMessages


def brute_keys(tables):
    out = set()
    for t, (cols, data) in tables.items():
        def unique(cs):
            vals = [tuple(r[cols.index(c)] for c in cs) for r in data]
            return bool(vals) and all(None not in v for v in vals) and len(set(vals)) == len(vals)
        one = [c for c in cols if unique([c])]
        out |= {(t, c, len(data)) for c in one}
        whole = [c for c in cols if not c.endswith("text") and c not in one]
        out |= {(t, f"{a},{b}", len(data)) for a, b in combinations(whole, 2) if unique([a, b])}
    return out


def brute_inclusions(tables):
    vals = {(t, c): {r[i] for r in data} - {None} for t, (cols, data) in tables.items() for i, c in enumerate(cols)}
    keys = {(t, c) for t, c, _ in brute_keys(tables) if "," not in c}
    return {(*a, *b, len(vals[a]), len(vals[b])) for a in vals for b in keys if a[0] != b[0] and vals[a] and vals[a] <= vals[b]}


@pytest.mark.parametrize("seed", [1, 2])
def test_keys_and_inclusions(spark, rows, seed):
    rnd = random.Random(seed)
    tables = {
        "parent": (["p_id", "p_text"], [(i, f"n{i}") for i in range(30)]),
        "child": (["c_no", "c_line", "c_id", "c_text"], [(i // 3, i % 3, rnd.choice([None, *range(20)]), rnd.choice(["n1", "n2", "1"])) for i in range(60)]),
        "other": (["o_id", "o_text"], [(rnd.randrange(40), rnd.choice([None, "x", "n3"])) for _ in range(50)]),
        "holes": (["h_id", "h_text"], [(None, "a"), (1, "b"), (2, "c")]),
        "nothing": (["e_id", "e_text"], []),
    }
    frames = {t: rows(", ".join(f"{c} {'string' if c.endswith('text') else 'bigint'}" for c in cols) + ", v double", *[(*r, 0.5) for r in data])
              for t, (cols, data) in tables.items()}
    d = Dependencies(frames)
    assert {tuple(r) for r in d.keys().collect()} == brute_keys(tables)
    got = d.inclusions().collect()
    assert {tuple(r)[:6] for r in got} == brute_inclusions(tables)
    assert ("child", "c_no,c_line", 60) in brute_keys(tables)
    assert ("child", "c_id", "parent", "p_id") in {tuple(r)[:4] for r in got if r.named}
    assert ("child", "c_line", "parent", "p_id") in {tuple(r)[:4] for r in got if not r.named}


def test_numbers_and_texts_do_not_meet(rows):
    d = Dependencies({"a": rows("id bigint", (1,), (2,)), "b": rows("id string", ("1",), ("2",))})
    assert d.inclusions().collect() == []
    with pytest.raises(ValueError, match="whole numbers"):
        Dependencies({"a": rows("v double", (1.0,))})


def test_star_schema_relations(spark):
    from lakeloom.plans.discovery import all_tables
    from lakeloom.plans.frames import Frames
    got = {(r.child_column, r.parent_column) for r in Dependencies(all_tables(Frames(spark, "/root/testdata/sf0.001"))).inclusions().where("named").collect()}
    assert got == {("n_regionkey", "r_regionkey"), ("o_custkey", "c_custkey"), ("s_nationkey", "n_nationkey"), ("c_nationkey", "n_nationkey"),
                   ("l_suppkey", "s_suppkey"), ("l_orderkey", "o_orderkey"), ("l_partkey", "p_partkey"), ("doc_id", "doc_id")}


DAYS = "ts timestamp_ntz, id bigint, v double, name string"


def day_rows(n, seed):
    rnd = random.Random(seed)
    start = dt.datetime(2024, 3, 1)
    return [(rnd.choice([None] + [start + dt.timedelta(hours=rnd.randrange(240))] * 30), i, rnd.choice([None, rnd.gauss(0, 100)]), rnd.choice([None, "", "a", f"u{rnd.randrange(900)}"]))
            for i in range(n)]


def test_day_profiles_merge_to_any_period(spark, rows, tmp_path):
    data = day_rows(20_000, 3)
    df = rows(DAYS, *data)
    p = DayProfiles(spark, str(tmp_path / "p"), df.schema, "ts")
    p.add(df)
    for start, end in ((None, None), (dt.date(2024, 3, 2), dt.date(2024, 3, 6)), (dt.date(2024, 3, 9), None)):
        part = [r for r in data if (start is None and end is None) or (r[0] and (not start or r[0].date() >= start) and (not end or r[0].date() < end))]
        got = {r.column_name: r for r in p.period(start, end).collect()}
        assert set(got) == {"ts", "id", "v", "name"}
        for i, c in enumerate(["ts", "id", "v", "name"]):
            vals = [r[i] for r in part if r[i] is not None]
            assert (got[c].n_rows, got[c].n_null) == (len(part), len(part) - len(vals))
            assert abs(got[c].n_distinct - len(set(vals))) <= 0.05 * len(set(vals))
            if c in ("id", "v"):
                s = sorted(vals)
                assert float(got[c].min_value) == s[0] and float(got[c].max_value) == s[-1]
                for q, at in ((0.5, got[c].median), (0.95, got[c].p95)):
                    assert bisect_left(s, at) / len(s) - 0.05 <= q <= bisect_right(s, at) / len(s) + 0.05
            else:
                assert got[c].median is None and got[c].p95 is None
    assert p.period(dt.date(2030, 1, 1)).collect() == []


def test_a_day_is_replaced_and_read_alone(spark, rows, tmp_path):
    data = [r for r in day_rows(500, 4) if r[0]]
    rows(DAYS, *data).write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    p = DayProfiles(spark, str(tmp_path / "p"), t.schema, "ts")
    p.add(t)
    once = sorted(map(str, p.period().drop("median", "p95").collect()))
    day = dt.date(2024, 3, 4)
    p.add_day(t, day)
    assert sorted(map(str, p.period().drop("median", "p95").collect())) == once
    p.add_day(t.unionByName(t), day)
    n = sum(1 for r in data if r[0].date() == day)
    assert p.period().first().n_rows == len(data) + n
    assert p.period(day, day + dt.timedelta(days=1)).first().n_rows == 2 * n
    plan = p.period(day, day + dt.timedelta(days=1))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    with pytest.raises(ValueError, match="nested"):
        DayProfiles(spark, "x", rows("ts timestamp_ntz, a array<int>").schema, "ts")


def test_a_column_of_nulls_has_a_profile(spark, rows, tmp_path):
    df = rows(DAYS, (dt.datetime(2024, 3, 1), None, None, None), (None, None, None, None))
    p = DayProfiles(spark, str(tmp_path / "p"), df.schema, "ts")
    p.add(df)
    got = {r.column_name: tuple(r)[1:] for r in p.period().collect()}
    assert got["v"] == (2, 2, 0, None, None, None, None) and got["name"] == (2, 2, 0, None, None, None, None)
    assert got["ts"][:2] == (2, 1)


def test_exact_distinct(rows):
    df = rows("a bigint, b string", (1, None), (1, "x"), (2, "x"), (None, None))
    assert {tuple(r) for r in exact_distinct(df, ["a", "b"]).collect()} == {("a", 2), ("b", 1)}


RULE = [Rule("small", "v < 30"), Rule("known", "v IS NOT NULL")]


def test_intervals_cover_the_full_value(spark):
    """400 draws of the same 3,000 rows: close to 95 % of the intervals hold the full share."""
    pop = spark.range(3000).select("id", F.expr("CASE WHEN id < 40 THEN 'few' WHEN id < 1000 THEN 'a' ELSE 'b' END").alias("g"),
                                   F.expr("CASE WHEN id % 20 = 0 THEN NULL ELSE (id * 7919) % 100 END").alias("v"))
    df = pop.crossJoin(spark.range(400).withColumnRenamed("id", "rep"))  # a test of 400 samples at once
    est = sampling.estimated_failures(df, ["id"], ["rep", "g"], RULE, 150, F.col("rep"), by=["rep"])
    full = {r.name: 100 * pop.where(f"({r.predicate}) IS NOT TRUE").count() / 3000 for r in RULE}
    got = est.collect()
    assert len(got) == 800
    for name, want in full.items():
        mine = [r for r in got if r.rule == name]
        assert 0.91 <= sum(r.low_pct <= want <= r.high_pct for r in mine) / 400 <= 0.99
        assert abs(sum(r.estimate_pct for r in mine) / 400 - want) < 0.5
    assert all(240 <= r.sample_rows <= 440 for r in got)


def test_a_sample_depends_on_keys_alone(spark):
    df = spark.range(2000).withColumn("g", F.when(F.col("id") < 5, None).otherwise(F.col("id") % 2))
    a = {tuple(r) for r in sampling.stratified_sample(df, ["id"], ["g"], 100).collect()}
    b = {tuple(r) for r in sampling.stratified_sample(df.repartition(13, "g").orderBy(F.desc("id")), ["id"], ["g"], 100).collect()}
    assert a == b and {r[0] for r in a} >= set(range(5))  # the stratum of nulls is whole
    assert {tuple(r) for r in sampling.stratified_sample(df, ["id"], ["g"], 100, 1).collect()} != a
    assert sampling.stratified_sample(df.where("1 = 0"), ["id"], ["g"], 100).collect() == []


def test_strata_beyond_the_bound_are_joined(spark, monkeypatch):
    df = spark.range(600).withColumn("g", F.col("id") % 50)
    want = {tuple(r) for r in sampling.stratified_sample(df, ["id"], ["g"], 4).collect()}
    monkeypatch.setattr(sampling, "MOST_STRATA", 10)
    assert {tuple(r) for r in sampling.stratified_sample(df, ["id"], ["g"], 4).collect()} == want


def test_one_row_of_a_stratum_gives_no_interval(rows):
    data = [(i, "a", 1) for i in range(2)]
    df = rows("id bigint, g string, v int", *data)
    seed = next(s for s in range(200) if sampling.stratified_sample(df, ["id"], ["g"], 1, s).count() == 1)
    r = sampling.estimated_failures(df, ["id"], ["g"], [Rule("x", "v = 1")], 1, seed).first()
    assert r.sample_rows == 1 and r.low_pct is None and r.high_pct is None
    seed = next(s for s in range(200) if sampling.stratified_sample(df, ["id"], ["g"], 1, s).count() == 0)
    r = sampling.estimated_failures(df, ["id"], ["g"], [Rule("x", "v = 1")], 1, seed).first()
    assert r.sample_rows == 0 and r.estimate_pct is None and r.low_pct is None


def test_pool_numbers_have_no_gaps(spark):
    pool = spark.range(0, 3000, 7).withColumnRenamed("id", "k")
    whole = {tuple(r) for r in sampling.shuffled_numbers(pool, "k", "n", 429).select("k", "n").collect()}
    cut = {tuple(r) for r in sampling.shuffled_numbers(pool, "k", "n", 429, 20).select("k", "n").collect()}
    assert whole == cut and {n for _, n in whole} == set(range(429))


def test_gaps_lose_no_rows(spark, rows):
    keys = spark.range(500).withColumnRenamed("id", "c")
    pool = rows("product_id bigint, product_name string, category string, list_price decimal(18,2)", *[(i, f"p{i}", "c", Decimal(1)) for i in (3, 900, 70_000)])
    a = synthetic_orders(keys, pool, dt.date(2024, 1, 1), 30, 1)
    b = synthetic_orders(keys.repartition(7), pool.repartition(3), dt.date(2024, 1, 1), 30, 1)
    assert {tuple(r) for r in a.collect()} == {tuple(r) for r in b.collect()} and a.count() == 500
    assert {r[0] for r in a.select("product_id").distinct().collect()} == {3, 900, 70_000}
    assert sampling.seeded_pick(keys, "c", pool.where("1 = 0"), "product_id", 1).collect() == []


COLUMNS = "conv bigint, turn bigint, text string, at timestamp_ntz"
T0 = dt.datetime(2024, 1, 1)


def replay(batches, keep, idle):
    """Conversation -> [(turn, text)], and those that are live."""
    state, clock = {}, None
    for batch in batches:
        batch = [r for r in batch if None not in (r[0], r[1], r[3])]
        for c in {r[0] for r in batch}:
            old = state.get(c, {})
            if old and (clock - max(t for _, t in old.values())).total_seconds() > idle:
                old = {}
            new = dict(old)
            for _, turn, text, at in [r for r in batch if r[0] == c]:
                key = lambda x: (x[0] is not None, x[0] or "", x[1])
                if turn not in new or key((text, at)) > key(new[turn]):
                    new[turn] = (text, at)
            state[c] = dict(sorted(new.items())[-keep:])
        clock = max([r[3] for r in batch] + ([clock] if clock else []), default=None)
    lists = {c: [(t, x[0]) for t, x in s.items()] for c, s in state.items()}
    return lists, {c for c, s in state.items() if (clock - max(t for _, t in s.values())).total_seconds() <= idle}


def test_recent_messages_follow_a_replay(spark, rows, tmp_path):
    rnd = random.Random(8)
    batches = []
    for b in range(5):
        batches.append([(rnd.choice([None, *range(12)]) if b % 2 else rnd.randrange(6), rnd.choice([None, *range(40)]), rnd.choice([None, "x", "y"]),
                         T0 + dt.timedelta(seconds=b * 500 + rnd.randrange(300))) for _ in range(rnd.choice([60, 120]))])
    batches.insert(2, [])
    kept = RecentMessages(spark, str(tmp_path / "s"), "conv", "turn", "at", COLUMNS, 5, 600, 4)
    for i, batch in enumerate(batches):
        kept.apply(rows(COLUMNS, *batch), i)
        if i == 3:
            kept.apply(rows(COLUMNS, *batch), i)  # a retried batch
        lists, live = replay(batches[:i + 1], 5, 600)
        got = kept.state().collect()
        assert {r.conv: [(m.turn, m.text) for m in r.messages] for r in got} == lists
        assert {r.conv for r in got if r.live} == live
    assert 0 < len(live) < len(lists)
    small = kept.compact(str(tmp_path / "c"), len(batches) - 1)
    assert {r.conv for r in small.state().collect()} == live  # idle state has left
    more = [(0, 99, "z", T0 + dt.timedelta(seconds=2600)), (77, 1, "q", T0)]
    for k in (kept, small):
        k.apply(rows(COLUMNS, *more), len(batches))
    lists, live = replay([*batches, more], 5, 600)
    assert {r.conv: [(m.turn, m.text) for m in r.messages] for r in small.live().collect()} == {c: lists[c] for c in live}
    assert {r.conv for r in kept.live().collect()} == live


def test_a_long_conversation_is_trimmed_before_it_is_gathered(spark, rows, tmp_path):
    kept = RecentMessages(spark, str(tmp_path), "conv", "turn", "at", COLUMNS, 20)
    kept.apply(spark.range(5000).selectExpr("1L AS conv", "id AS turn", "'m' AS text", "timestamp_ntz '2024-01-01 00:00:00' AS at"), 0)
    r = kept.live().first()
    assert [m.turn for m in r.messages] == list(range(4980, 5000))
    assert "WindowGroupLimit" in kept._last(rows(COLUMNS, (1, 1, "a", T0)))._jdf.queryExecution().executedPlan().toString()
