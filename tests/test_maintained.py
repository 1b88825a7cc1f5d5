"""Maintained summaries and two-level reconciliation against a recomputation."""

import datetime as dt
import random
import re
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import migration
from lakeloom.operators.maintained import MaintainedSummary

COLUMNS = "k bigint, m date, g string, v decimal(18,2)"
CHANGES = COLUMNS + ", seq bigint, op string"
MONTHS = [dt.date(2024, i, 1) for i in range(1, 7)] + [None]


def recomputed(batches):
    """Month, group, rows, sum from the newest change of each key."""
    newest = {}
    for batch in batches:
        for k, m, g, v, seq, op in batch:
            if k not in newest or seq > newest[k][0]:
                newest[k] = (seq, op, m, g, v)
    out = defaultdict(list)
    for _, op, m, g, v in newest.values():
        if op != "D":
            out[m, g].append(v)
    return {(m, g, len(vs), sum((v for v in vs if v is not None), Decimal(0)) if any(v is not None for v in vs) else None)
            for (m, g), vs in out.items()}


def kept(spark, root):
    return MaintainedSummary(spark, root, "k", "m", ["g"], ["v"], COLUMNS, buckets=8)


def rows_of(summary, where=None):
    return {tuple(r) for r in summary.summary(where).collect()}


def test_summary_equals_a_recomputation(spark, rows, tmp_path):
    rnd = random.Random(5)
    seqs = rnd.sample(range(10_000), 900)  # batches bring late changes too
    every = [(rnd.choice([None, *range(60)]), rnd.choice(MONTHS), rnd.choice(["a", "b", None]),
              rnd.choice([None, Decimal(rnd.randrange(-999, 999)) / 100]), s, rnd.choice("IUUD")) for s in seqs]
    batches = [every[:500], every[500:700], [], every[700:]]
    s = kept(spark, str(tmp_path / "s"))
    for i, batch in enumerate(batches):
        s.apply(rows(CHANGES, *batch), i)
        assert rows_of(s) == recomputed(batches[:i + 1])
    s.apply(rows(CHANGES, *batches[3]), 3)  # a replay changes nothing
    assert rows_of(s) == recomputed(batches)
    again = kept(spark, str(tmp_path / "s")).open()
    assert again.last == 3 and rows_of(again) == recomputed(batches)
    small = again.compact(str(tmp_path / "c"))
    small.apply(rows(CHANGES, *batches[3]), 3)  # folded already
    assert rows_of(small) == recomputed(batches)
    more = [(5, MONTHS[0], "a", Decimal("1.00"), 20_000, "U"), (6, None, None, None, 20_001, "D")]
    for x in (small, kept(spark, str(tmp_path / "c")).open()):
        x.apply(rows(CHANGES, *more), 4)
        assert rows_of(x) == recomputed([*batches, more])


def test_a_batch_touches_its_own_months_and_keys_only(spark, rows, tmp_path):
    s = kept(spark, str(tmp_path))
    s.apply(rows(CHANGES, *[(k, MONTHS[k % 6], "a", Decimal(k), 0, "I") for k in range(300)]), 0)
    s.apply(rows(CHANGES, (1, MONTHS[4], "a", Decimal(7), 1, "U"), (2, MONTHS[2], "b", Decimal(2), 1, "U"), (1000, None, "a", None, 1, "D")), 1)
    assert {r.m for r in s.changed_periods(1).collect()} == {MONTHS[1], MONTHS[4], MONTHS[2]}
    assert {p.name for p in (tmp_path / "totals" / "gen=1").glob("m=*")} == {f"m={m}" for m in (MONTHS[1], MONTHS[4], MONTHS[2])}
    assert len(list((tmp_path / "state" / "gen=1").glob("bucket=*"))) <= 3
    one = s.summary(F.col("m") == F.lit(MONTHS[1]))
    assert {tuple(r) for r in one.collect()} == {(MONTHS[1], "a", 49, Decimal(sum(k for k in range(300) if k % 6 == 1) - 1))}
    assert re.search(r"PartitionFilters: \[[^\]]*\(m#\d+ = 2024-02-01\)", one._jdf.queryExecution().toString())


def test_summary_refuses_what_it_cannot_keep_exactly(spark, rows, tmp_path):
    with pytest.raises(ValueError, match="exactly"):
        MaintainedSummary(spark, str(tmp_path), "k", "m", [], ["v"], "k bigint, m date, v double")
    s = kept(spark, str(tmp_path))
    s.apply(rows(CHANGES), 0)  # nothing at all
    assert rows_of(s) == set()
    s.apply(rows(CHANGES, (1, MONTHS[0], "a", None, 1, "I")), 1)
    assert rows_of(s) == {(MONTHS[0], "a", 1, None)}
    with pytest.raises(ValueError, match="comes after"):
        s.apply(rows(CHANGES), 0)


@pytest.mark.parametrize("kind", ["bigint", "int", "string", "date"])
def test_ranges_find_what_rows_find(spark, rows, kind):
    rnd = random.Random(7)
    src = [(k, rnd.choice([None, "x", "y"]), (k or 0) % 5) for k in [*range(-40, 400), *range(0, 30), None, None]]
    copy = [r for r in src if r[0] not in (3, 77)] + [(900, "x", 1), (-500, None, 2)]
    copy = [(k, "z" if k in (-40, 12, None) else a, b) for k, a, b in copy] + [copy[60]]

    def side(data):
        df = rows("k bigint, a string, b bigint", *data)
        return df.withColumn("k", F.date_from_unix_date(F.col("k").cast("int")) if kind == "date" else F.col("k").cast(kind))

    a, b = side(src), side(copy)
    want = {tuple(r) for r in migration.reconcile_rows(a, b, "k").collect()}
    for width in (1, 16, 1 << 16):
        assert {tuple(r) for r in migration.reconcile_ranges(a, b, "k", width).collect()} == want
    assert len(want) >= 7
    assert migration.reconcile_ranges(a, side(src[::-1]), "k").collect() == []
    empty = a.where("1 = 0")
    assert {r.status for r in migration.reconcile_ranges(empty, b, "k", 8).collect()} == {"extra"}
    assert migration.reconcile_ranges(empty, empty, "k").collect() == []


def test_ranges_reach_the_scan(spark, tmp_path):
    df = spark.range(5000).withColumn("v", F.col("id") % 7)
    df.write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    got = migration.reconcile_ranges(t, t.where("id <> 2050"), "id", 100)
    assert [tuple(r) for r in got.collect()] == [(2050, "missing")]
    assert "GreaterThanOrEqual(id,2000), LessThanOrEqual(id,2099)" in got._jdf.queryExecution().toString()
