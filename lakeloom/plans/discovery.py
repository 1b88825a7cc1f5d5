"""Keys and relationships found in all tables."""

from __future__ import annotations

from itertools import combinations

from lakeloom.operators.dependencies import WHOLE, Dependencies
from lakeloom.plans.registry import query
from lakeloom.sources.tables import SCHEMAS

COLUMNS = {t: [tuple(c.strip().split(" ")) for c in ddl.split(",")] for t, ddl in SCHEMAS.items()}
VALUES = {t: [(c, f"CAST({c} AS VARCHAR)" if k in WHOLE else f"'t' || md5({c})") for c, k in cols if k in WHOLE or k == "string"]
          for t, cols in COLUMNS.items()}
KEYS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS key_columns, count(*) AS n_rows FROM {t} HAVING count(*) > 0 AND count(DISTINCT {c}) = count(*)"
    for t, cols in VALUES.items() for c, _ in cols)
PAIRS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{a},{b}' AS key_columns, count(*) AS n_rows FROM {t} HAVING count(*) > 0 AND count({a}) = count(*) AND count({b}) = count(*) "
    f"AND count(DISTINCT {a}) < count(*) AND count(DISTINCT {b}) < count(*) AND count(DISTINCT ({a}, {b})) = count(*)"
    for t, cols in COLUMNS.items() for a, b in combinations([c for c, k in cols if k in WHOLE], 2))


def all_tables(f) -> dict:
    return {t: getattr(f, t) for t in SCHEMAS}


@query("key_discovery", f"{KEYS} UNION ALL {PAIRS}")
def _keys(f):
    """Single and paired keys of all tables."""
    d = Dependencies(all_tables(f))
    return d.keys()


@query("inclusion_discovery", f"""WITH k AS ({KEYS}), vals AS ({" UNION ALL ".join(
    f"SELECT DISTINCT '{t}' AS t, '{c}' AS c, {v} AS v FROM {t} WHERE {c} IS NOT NULL" for t, cols in VALUES.items() for c, v in cols)}),
n AS (SELECT t, c, count(*) AS n FROM vals GROUP BY 1, 2), parents AS (SELECT vals.* FROM vals JOIN k ON t = table_name AND c = key_columns),
met AS (SELECT a.t AS ct, a.c AS cc, b.t AS pt, b.c AS pc, count(*) AS n FROM vals a JOIN parents b ON a.v = b.v AND a.t <> b.t GROUP BY 1, 2, 3, 4)
SELECT ct AS child_table, cc AS child_column, pt AS parent_table, pc AS parent_column, x.n AS n_values, y.n AS n_parent_values,
  regexp_replace(cc, '^[a-z]{{1,2}}_', '') = regexp_replace(pc, '^[a-z]{{1,2}}_', '') AS named
FROM met JOIN n x ON x.t = ct AND x.c = cc AND x.n = met.n JOIN n y ON y.t = pt AND y.c = pc""")
def _inclusions(f):
    """Columns that lie in a key of another table; the named ones are relationships."""
    return Dependencies(all_tables(f)).inclusions()
