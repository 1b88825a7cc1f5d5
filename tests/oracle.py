"""Run registered queries against their SQL twins: python tests/oracle.py [name ...] (SF_DIR)."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.01")


def duck(folder: str):
    con = duckdb.connect()
    for name in ("region nation customer supplier part orders lineitem events documents embeddings "
                 "pages benchmark labels conversations").split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, dict):
        return tuple((k, norm(x)) for k, x in v.items())
    if hasattr(v, "asDict"):
        return tuple((k, norm(x)) for k, x in v.asDict().items())
    if isinstance(v, (list, tuple)) or hasattr(v, "tolist"):
        return tuple(norm(x) for x in v)
    return v


def kind(t: str) -> str:
    """Coarse type of a column, to see an int where the twin has a double."""
    t = t.lower()
    for key, names in (("int", ("bigint", "int", "smallint", "long", "integer", "hugeint", "tinyint")),
                       ("double", ("double", "float")), ("string", ("string", "varchar")),
                       ("bool", ("boolean",)), ("date", ("date",))):
        if t in names:
            return t if key == "int" and t == "hugeint" else key
    if t.startswith("timestamp"):
        return "timestamp"
    if t.startswith("decimal"):
        return "decimal"
    return "nested"


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, fn, sql, folder):
    """None if equal, else a message."""
    df = fn(spark, folder)
    got_cols = df.columns
    got = rows_of(got_cols, df.collect())
    if sql is None:
        return None, len(got)
    rel = con.sql(sql)
    want_cols = rel.columns
    want = rows_of(want_cols, rel.fetchall())
    if sorted(got_cols) != sorted(want_cols):
        return f"columns {sorted(got_cols)} != {sorted(want_cols)}", len(got)
    st = {c: kind(t) for c, t in df.dtypes}
    dtp = {c: kind(str(t)) for c, t in zip(rel.columns, rel.types)}
    bad = [(c, st[c], dtp[c]) for c in st if st[c] != dtp[c]]
    if bad:
        return f"types {bad}", len(got)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}", len(got)
    for g, w in zip(got, want):
        if repr(g) != repr(w) and g != w:
            return f"got {str(g)[:300]} want {str(w)[:300]}", len(got)
    return None, len(got)


def main(names):
    import __spark_entry__ as entry
    from lakeloom.session import local_session
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(SF_DIR)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    picked = [n for n in queries if not names or n in names or
              any(x.endswith("*") and n.startswith(x[:-1]) for x in names)]
    for name in picked:
        t0 = time.time()
        try:
            msg, n = compare(spark, con, queries[name], oracle.get(name), SF_DIR)
        except Exception as e:  # report and go on
            msg, n = f"{type(e).__name__}: {str(e)[:1200]}", -1
        dt_ = time.time() - t0
        if msg:
            bad += 1
            print(f"FAIL {name} ({dt_:.1f}s) {msg}", flush=True)
        elif n == 0 or dt_ > 6 or os.environ.get("VERBOSE"):
            print(f"note {name} rows={n} ({dt_:.1f}s) {'D' if name in oracle else 'R'}", flush=True)
    print(f"{len(picked)} checked, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
