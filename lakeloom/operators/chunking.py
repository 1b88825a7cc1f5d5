"""Documents to chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.text import fixed_windows, lines


def chunk_lines(docs: DataFrame, keep: list[str], text: str, min_chars: int = 10) -> DataFrame:
    """One chunk per line longer than ``min_chars`` after trimming.

    ``chunk_index`` is the 0-based position of the line, so dropped lines leave gaps.
    """
    out = docs.select(*keep, F.posexplode_outer(lines(text)).alias("chunk_index", "_line"))
    out = out.withColumn("chunk_text", F.trim("_line")).drop("_line")
    return out.where(F.length("chunk_text") > min_chars)


def chunk_nonblank(docs: DataFrame, keep: list[str], text: str) -> DataFrame:
    """Variant that only drops blank lines."""
    return chunk_lines(docs, keep, text, 0)


def chunk_fixed(docs: DataFrame, keep: list[str], text: str, size: int = 500, overlap: int = 100) -> DataFrame:
    """Character windows that share ``overlap`` characters with their neighbour."""
    out = docs.select(*keep, F.explode_outer(fixed_windows(text, size, overlap)).alias("_w"))
    return out.select(*keep, F.col("_w.pos").alias("chunk_index"), F.col("_w.chunk_text").alias("chunk_text"))
