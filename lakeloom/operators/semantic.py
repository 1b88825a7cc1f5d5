"""Semantic layer: declared measures, dimensions and relationships compiled to one grouped query."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeloom.functions.dates import grain_of
from lakeloom.functions.text import CJK, WORD_BREAK
from lakeloom.operators.joins import contains_join
from lakeloom.sources.inline import values_relation

AGGREGATIONS = ("sum", "avg", "count", "min", "max", "count_distinct")


@dataclass(frozen=True)
class Measure:
    """An aggregate: either a full expression or a column with a default aggregation."""

    name: str
    expr: str
    default_aggregation: str | None = None
    synonyms: tuple[str, ...] = ()

    def column(self) -> Column:
        agg = self.default_aggregation
        if agg is None:
            return F.expr(self.expr).alias(self.name)
        if agg not in AGGREGATIONS:
            raise ValueError(f"unknown aggregation {agg}")
        if agg == "count_distinct":
            return F.countDistinct(F.expr(self.expr)).alias(self.name)
        return getattr(F, agg)(F.expr(self.expr)).alias(self.name)


@dataclass(frozen=True)
class Relationship:
    """N:1 join from the fact table to a dimension table."""

    table: str
    keys: tuple[str, ...]
    fields: tuple[str, ...]
    how: str = "left"


@dataclass
class Model:
    """One fact table with its measures and the dimensions it can reach."""

    name: str
    measures: dict[str, Measure]
    dimensions: dict[str, str] = field(default_factory=dict)     # name -> expression on the fact
    time_dimensions: tuple[str, ...] = ()
    relationships: tuple[Relationship, ...] = ()
    facts: dict[str, str] = field(default_factory=dict)          # row-level expressions
    synonyms: dict[str, str] = field(default_factory=dict)       # term -> measure, dimension or filter


def _resolves(df: DataFrame, condition: str | Column, *without: str) -> bool:
    """Whether the columns of ``df`` are all that the condition names (a plan may hide more)."""
    shape = df.sparkSession.createDataFrame([], StructType([x for x in df.schema.fields if x.name not in without]))
    try:
        shape.where(condition)
        return True
    except AnalysisException:
        return False


def metric_query(model: Model, table: Callable[[str], DataFrame], measures: list[str],
                 dims: list[str] = (), grain: tuple[str, str] | None = None,
                 filters: list[str | Column] = ()) -> DataFrame:
    """Group the fact by dimensions and a time grain; every fact row counts once in each group it belongs to.

    Measures are summed at the grain of the fact, whatever the dimension tables hold: a dimension is joined as the distinct
    combinations of its key and the requested fields, so rows that repeat a key do not multiply
    sums, and one that only a filter names is a semi join. A key with several values of a requested field
    puts its facts into each of these groups. Filters are SQL or columns; each goes to
    the table that has all its fields. Only relationships that a dimension or a filter needs are joined.
    """
    fact = table(model.name)
    for name, expr in model.facts.items():
        fact = fact.withColumn(name, F.expr(expr))
    seen: dict[Relationship, DataFrame] = {}

    def dim(rel: Relationship) -> DataFrame:
        if rel not in seen:
            seen[rel] = table(rel.table).select(*rel.keys, *rel.fields)
        return seen[rel]

    own: dict[Relationship, list] = {}
    late = []
    for f in filters:
        if _resolves(fact, f):
            fact = fact.where(f)
            continue
        at = next((rel for rel in model.relationships if _resolves(dim(rel), f)), None)
        # a condition that holds without a dimension row must see the facts that have none
        if at and _nothing(dim(at)).where(f).isEmpty():
            own.setdefault(at, []).append(f)
        else:
            late.append(f)
    wanted = {rel: [c for c in rel.fields if c in dims and c not in fact.columns] for rel in model.relationships}
    extra = _needed(fact, {rel: dim(rel) for rel in model.relationships}, wanted, late) if late else {}
    row = bool(late and any(extra.values()))
    if row:  # a filter over fields that are no group could meet a fact twice
        fact = fact.withColumn("_row", F.monotonically_increasing_id())
    df = fact
    for rel in model.relationships:
        fields = [*wanted[rel], *extra.get(rel, [])]
        if not fields and rel not in own:
            continue
        d = dim(rel)
        for f in own.get(rel, []):
            d = d.where(f)
        if fields:
            df = df.join(d.select(*rel.keys, *fields).distinct(), list(rel.keys), "inner" if rel in own else rel.how)
        else:
            df = df.join(d.select(*rel.keys), list(rel.keys), "left_semi")
    for f in late:
        df = df.where(f)
    if row:
        df = df.dropDuplicates(["_row", *[d for d in dims if d in df.columns]])
    keys = [F.expr(model.dimensions.get(d, d)).alias(d) for d in dims]
    if grain:
        col, unit = grain
        if col not in model.time_dimensions:
            raise ValueError(f"{col} is not a time dimension of {model.name}")
        keys.insert(0, grain_of(col, unit).alias(unit))
    return df.groupBy(*keys).agg(*[model.measures[m].column() for m in measures])


def _nothing(df: DataFrame) -> DataFrame:
    """One row of nulls."""
    return df.sparkSession.range(1).select(*[F.lit(None).cast(x.dataType).alias(x.name) for x in df.schema.fields])


def _needed(fact: DataFrame, dim_tables: dict, wanted: dict, late: list) -> dict:
    """Further fields that the late filters need, by relationship."""
    got: dict = {}
    for f in late:
        have = fact.limit(0)
        for rel, d in dim_tables.items():
            have = have.join(d.limit(0), list(rel.keys), "left")
        if not _resolves(have, f):
            raise ValueError(f"a filter names no field of the model: {f}")
        for rel, d in dim_tables.items():
            for c in rel.fields:
                if c in have.columns and not _resolves(have, f, c):
                    got.setdefault(rel, [])
                    if c not in got[rel] and c not in wanted[rel]:
                        got[rel].append(c)
    return got


def metrics_across(parts: list[tuple[Model, list[str]]], table: Callable[[str], DataFrame], dims: list[str],
                   grain: tuple[str, str] | None = None, filters: list[str | Column] = ()) -> DataFrame:
    """Measures of several facts side by side on the dimensions they share.

    Each fact is grouped by itself and only the groups meet, null-safe; a group that a fact does not have has
    null measures there. Filters apply to every fact and so name shared dimensions.
    """
    keys = [*([grain[1]] if grain else []), *dims]
    out = None
    for model, measures in parts:
        g = metric_query(model, table, measures, dims, grain, filters)
        if out is None:
            out = g
            continue
        g = g.select(*[F.col(k).alias(f"_{k}") for k in keys], *measures)
        on = F.lit(True)
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
        both = out.withColumn("_a", F.lit(True)).join(g, on, "full_outer")
        out = both.select(*[F.when(F.col("_a"), F.col(k)).otherwise(F.col(f"_{k}")).alias(k) for k in keys],
                          *[c for c in out.columns if c not in keys], *measures)
    return out


def read_model(spec: dict) -> dict[str, Model]:
    """Models from a parsed YAML document, in either dialect.

    One dialect lists ``measures`` and ``time_dimensions``; the other ``dimensions``, ``facts``
    and ``metrics`` with synonyms. Relationships name a left and a right table with key pairs.
    """
    models: dict[str, Model] = {}
    fields: dict[str, set[str]] = {}
    for t in spec.get("tables", []):
        measures, synonyms = {}, {}
        for m in [*t.get("measures", []), *t.get("metrics", [])]:
            measures[m["name"]] = Measure(m["name"], str(m.get("expr", m["name"])).strip(),
                                          m.get("default_aggregation"), tuple(m.get("synonyms", [])))
        dims = {}
        for d in [*t.get("dimensions", []), *t.get("columns", [])]:
            name = d.get("name", d.get("column_name"))
            dims[name] = d.get("expr", name)
            for s in d.get("synonyms", []):
                synonyms[s] = name
        for m in measures.values():
            synonyms.update({s: m.name for s in m.synonyms})
        times = tuple(d.get("name", d.get("column_name")) for d in t.get("time_dimensions", []))
        facts = {x["name"]: x["expr"] for x in t.get("facts", [])}
        models[t["name"]] = Model(t["name"], measures, dims, times, (), facts, synonyms)
        fields[t["name"]] = set(dims) | set(times)
    for r in spec.get("relationships", []):
        keys = tuple(c["left_column"] for c in r["relationship_columns"])
        left, right = models[r["left_table"]], r["right_table"]
        rel = Relationship(right, keys, tuple(sorted(fields[right] - set(keys) - fields[left.name])),
                           {"left_outer": "left", "full": "full_outer"}.get(r.get("join_type", "left"),
                                                                             r.get("join_type", "left")))
        left.relationships = (*left.relationships, rel)
    return models


def resolve_terms(texts: DataFrame, text_col: str, key: str, synonyms: DataFrame) -> DataFrame:
    """Business words of each text mapped to columns or filters: rows (key, term, target).

    A term of Han or kana counts wherever the text contains it, as such sentences have no blanks; any other
    term only as whole words in a row. Case does not matter; ``term`` comes back as it was given.
    """
    def words(c):  # each word between blanks, so that a phrase is found by its words
        return F.concat(F.lit(" "), F.array_join(F.filter(F.split(F.lower(c), WORD_BREAK), lambda w: w != ""), " "), F.lit(" "))

    found = None
    for cjk in (True, False):
        some = synonyms.where(F.col("term").rlike(CJK) == cjk)
        body, term = (F.lower(text_col), F.lower("term")) if cjk else (words(text_col), words("term"))
        some = some.select("term", "target", term.alias("_term")).where(F.trim("_term") != "")
        hit = contains_join(texts.select(key, body.alias("_text")), "_text", some, "_term").select(key, "term", "target")
        found = hit if found is None else found.unionByName(hit)
    return found


def infer_model(df: DataFrame, name: str, max_values: int = 20) -> DataFrame:
    """Draft of a model from a table: role, approximate distinct count and sample values per column.

    Two scans: sketches for all columns first, then the values of the columns that turned out to
    have at most ``max_values`` of them.
    """
    stats = df.agg(*[F.approx_count_distinct(c).alias(c) for c, _ in df.dtypes]).first()
    few = [c for c, t in df.dtypes if t == "string" and stats[c] <= max_values]
    values = df.agg(*[F.slice(F.sort_array(F.collect_set(c)), 1, max_values).alias(c) for c in few]).first() if few else {}
    rows = []
    for c, t in df.dtypes:
        if c.endswith(("key", "_id")):
            role = "key"
        elif t.startswith(("date", "timestamp")):
            role = "time_dimension"
        elif t.startswith(("int", "bigint", "double", "float", "decimal", "smallint")):
            role = "measure"
        else:
            role = "dimension"
        rows.append((name, c, t, role, stats[c], ", ".join(values[c]) if c in few else None))
    return values_relation(df.sparkSession, ["table_name", "column_name", "data_type", "role", "approx_distinct", "sample_values"], rows)


def infer_relationships(tables: dict[str, DataFrame]) -> list[tuple[str, str, str]]:
    """Pairs of tables that share a key name after the table prefix is removed."""
    keys: dict[str, list[str]] = {}
    for name, df in tables.items():
        for c in df.columns:
            short = c.split("_", 1)[-1]
            if short.endswith(("key", "id")):
                keys.setdefault(short, []).append(name)
    return [(k, a, b) for k, names in sorted(keys.items())
            for i, a in enumerate(names) for b in names[i + 1:]]
