"""The ascending order of doc_id, cut into numbered slices of near equal row counts."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.base import order_key

SLICE_ROWS = 4096    # rows of a slice; more where there would be more than MOST_SLICES
MOST_SLICES = 16384  # numbers the driver holds
LOOKUP = 128


def bounds_of(docs: DataFrame) -> list[int]:
    """Lower ends of slices of the document order: at most MOST_SLICES numbers."""
    keys = docs.select(order_key().alias("k"))
    n = keys.count()
    parts = min(MOST_SLICES, -(-n // SLICE_ROWS))
    if parts < 2:
        return []
    shares = json.dumps([i / parts for i in range(1, parts)])
    got = keys.select(F.expr(f"percentile_approx(k, from_json('{shares}', 'array<double>'), {20 * parts})")).first()[0]
    return sorted(set(got))


def slice_of(bounds: list[int]) -> Column:
    """Number of bounds at or below the key, found in two steps."""
    if not bounds:
        return F.lit(0)
    head, most = bounds[::LOOKUP], len(bounds)
    fine = F.from_json(F.lit(json.dumps(bounds)), "array<bigint>")
    coarse = F.from_json(F.lit(json.dumps(head)), "array<bigint>")
    c = F.size(F.filter(coarse, lambda b: b <= F.col("k")))
    step = F.greatest(c - 1, F.lit(0)) * LOOKUP
    return F.least(F.lit(most), step + F.size(F.filter(F.slice(fine, step + 1, LOOKUP), lambda b: b <= F.col("k"))))
