"""Mixing to target weights by iterative proportional fitting (built-in functions only).

The token weight of each (source, language, topic) cell is raked to the three target marginals in turn.
A document is then sampled with a probability in proportion to its cell's calibrated over its present
share. The rate is the one at which the most wanted cell keeps all its documents; where that would keep
less than BUDGET of the tokens, it is the rate that keeps BUDGET, and cells too scarce for it keep all
they have. Whether a document is drawn depends on its id, the seed and that probability alone.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.base import documents, query, staged

AXES = ("source", "lang", "topic")
ROUNDS = 12
CUT_EVERY = 3             # rounds between staged tables
SEED = "mix-1"
SOURCES = 0.9             # a number: present tokens to this power
LANGUAGES = {"en": 0.66, "de": 0.13, "fr": 0.12, "es": 0.09}
TOPICS = {"short": 0.01, "plain": 0.54, "long": 0.45}
SHORT, LONG = 400, 6000   # bytes
BUDGET = 0.25             # part of the tokens that is kept at least
MOST_CELLS = 100_000      # cells that are broadcast; more are joined by a shuffle


def topic_of(text: Column) -> Column:
    """Default topic: short notes, plain articles, long reads, by UTF-8 bytes."""
    size = F.octet_length(text)
    return F.when(size < SHORT, "short").when(size > LONG, "long").otherwise("plain")


def _axes(docs: DataFrame, topic: Column | None) -> DataFrame:
    """Rows as struct ``row`` with their axes and tokens (bytes + 4 stand for them)."""
    text = F.coalesce(F.col("row.text"), F.lit(""))
    return docs.select(F.struct("*").alias("row")).select(
        "row", F.coalesce(F.col("row.source"), F.lit("")).alias("source"),
        F.coalesce(F.col("row.lang"), F.lit("")).alias("lang"),
        (topic_of(text) if topic is None else F.coalesce(topic, F.lit(""))).alias("topic"),
        (F.octet_length(text) + 4).cast("long").alias("tokens"))


def _goals(cells: DataFrame, axis: str, target: dict | float) -> DataFrame:
    """axis, ``goal_<axis>``: target shares of the values present (sum 1).

    A value that a dict does not name gets its present share, and the named ones share the rest.
    """
    present = cells.groupBy(axis).agg(F.sum("tokens").alias("t"))
    if isinstance(target, dict):
        known = F.from_json(F.lit(json.dumps(target)), "map<string, double>")
        want = F.element_at(known, F.col(axis))
    else:
        want = F.pow(F.col("t").cast("double"), F.lit(float(target)))
    present = present.select(axis, "t", want.alias("want"))
    whole = present.agg(F.sum("want").alias("whole"), F.sum("t").cast("double").alias("all"),
                        F.coalesce(F.sum(F.when(F.col("want").isNull(), F.col("t"))), F.lit(0)).alias("other"))
    goal = F.when(F.col("want").isNull(), F.col("t") / F.col("all")) \
        .otherwise(F.col("want") / F.col("whole") * (1 - F.col("other") / F.col("all")))
    return present.crossJoin(F.broadcast(whole)).select(axis, goal.alias(f"goal_{axis}"))  # one row


def rake(cells: DataFrame, targets: dict[str, dict | float], rounds: int = ROUNDS) -> DataFrame:
    """Cells with calibrated share ``w`` and present share ``share``.

    The windows run over cells, of which there are at most as many as combinations of axis values.
    """
    whole = cells.agg(F.sum("tokens").cast("double").alias("whole"))
    state = cells.crossJoin(F.broadcast(whole)).withColumn("share", F.col("tokens") / F.col("whole")).drop("whole")  # one row
    for axis in AXES:
        state = state.join(_goals(cells, axis, targets[axis]), axis)
    state = state.withColumn("w", F.col("share"))
    for r in range(rounds):
        for axis in AXES:
            state = state.withColumn("w", F.col("w") * F.col(f"goal_{axis}") / F.sum("w").over(Window.partitionBy(axis)))
        if r % CUT_EVERY == CUT_EVERY - 1:
            state = staged(state, "rake")
    return state


def least_ratio(cells: DataFrame, most: float, budget: float) -> float:
    """The ratio w / share from which on a cell keeps all: ``most``, or less where that keeps under ``budget`` of the tokens.

    Fixed point of rate = (budget - shares of the cells that keep all) / weights of the others. The rate
    grows from step to step and with it the cells that keep all, so the steps end; the driver holds three numbers.
    """
    if 1 / most >= budget:
        return most
    ratio, full = 1 / budget, -1
    while True:
        scarce = F.col("ratio") >= ratio
        share, w, n = cells.agg(F.sum(F.when(scarce, F.col("share")).otherwise(0.0)),
                                F.sum(F.when(scarce, 0.0).otherwise(F.col("w"))), F.count_if(scarce)).first()
        if n == full or w <= 0 or share >= budget:
            return ratio
        ratio, full = min(ratio, w / (budget - share)), n


def mix(docs: DataFrame, sources: dict | float = SOURCES, languages: dict | float = LANGUAGES,
        topics: dict | float = TOPICS, topic: Column | None = None, rounds: int = ROUNDS, seed: str = SEED,
        budget: float = BUDGET) -> DataFrame:
    """Every row as struct ``row`` with its axes, probability and verdict ``kept``.

    A target is a dict of shares (brought to sum 1 over the values present; values it does not name keep
    their present share) or a power of the present tokens. The targets are met in full unless cells are so
    scarce that less than ``budget`` of the tokens would be kept; these then keep all. A null source, language or topic is the value ''; a null text has 4 tokens; a null id draws
    as the id ''. Rows that share an id are drawn alike if their cells are. An empty table gives no rows.
    """
    rows = _axes(docs, topic)
    cells = staged(rows.groupBy(*AXES).agg(F.sum("tokens").alias("tokens")), "cells")
    fitted = rake(cells, {"source": sources, "lang": languages, "topic": topics}, rounds)
    fitted = staged(fitted.select(*AXES, "w", "share", (F.col("w") / F.col("share")).alias("ratio")), "cells")
    n, most = fitted.agg(F.count(F.lit(1)), F.max("ratio")).first()
    least = least_ratio(fitted, most, budget) if n else 1.0
    wanted = fitted.select(*AXES, F.least(F.lit(1.0), F.col("ratio") / F.lit(least)).alias("probability"))
    if n <= MOST_CELLS:
        wanted = F.broadcast(wanted)
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("row.doc_id").cast("string"), F.lit("")))), 1, 12),
                  16, 10).cast("double") / float(1 << 48)
    return rows.join(wanted, list(AXES)).withColumn("kept", draw < F.col("probability"))


def _case(axis: str, target: dict) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in target.items())
    return f"CASE {axis} {whens} ELSE {min(target.values())!r} END"


def oracle(sources=SOURCES, languages=LANGUAGES, topics=TOPICS, rounds=ROUNDS, seed=SEED) -> str:
    """The same fitting and draw in DuckDB SQL, for tables where all values are named and no cell is too scarce for BUDGET."""
    want = {a: _case(a, t) if isinstance(t, dict) else f"pow(sum(tokens)::DOUBLE, {t!r})"
            for a, t in zip(AXES, (sources, languages, topics))}
    goals = ",\n".join(f"g_{a} AS (SELECT {a}, want / sum(want) OVER () AS goal_{a} FROM "
                       f"(SELECT {a}, {want[a]} AS want FROM cells GROUP BY {a}))" for a in AXES)
    step = "(SELECT c.*, tokens / (sum(tokens) OVER ())::DOUBLE AS w, tokens / (sum(tokens) OVER ())::DOUBLE AS share, " \
           "goal_source, goal_lang, goal_topic FROM cells c JOIN g_source USING (source) JOIN g_lang USING (lang) JOIN g_topic USING (topic))"
    for r in range(rounds):
        for a in AXES:
            step = f"(SELECT * REPLACE (w * goal_{a} / sum(w) OVER (PARTITION BY {a}) AS w) FROM {step})"
    return f"""
WITH r AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
  CASE WHEN strlen(coalesce(text, '')) < {SHORT} THEN 'short' WHEN strlen(coalesce(text, '')) > {LONG} THEN 'long' ELSE 'plain' END AS topic,
  strlen(coalesce(text, '')) + 4 AS tokens FROM documents),
cells AS (SELECT source, lang, topic, sum(tokens) AS tokens FROM r GROUP BY ALL),
{goals},
f AS (SELECT source, lang, topic, w / share AS ratio FROM {step}),
p AS (SELECT source, lang, topic, ratio / max(ratio) OVER () AS probability FROM f)
SELECT doc_id, source, lang, topic, CAST(tokens AS BIGINT) AS tokens, round(probability, 6) AS probability,
  CAST('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 12) AS BIGINT) / {float(1 << 48)!r} < probability AS kept
FROM r JOIN p USING (source, lang, topic)"""


@query("op9_mixing", oracle())
def op9_mixing(spark, folder):
    """Sampling probability and draw of every document."""
    return mix(documents(spark, folder)).select("row.doc_id", *AXES, "tokens", F.round("probability", 6).alias("probability"), "kept")
