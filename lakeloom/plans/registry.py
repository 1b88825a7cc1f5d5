"""Registry that keeps a Spark query and its SQL twin side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeloom.plans.frames import FRAME_SQL, Frames

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def with_frames(sql: str, frames: tuple[str, ...]) -> str:
    """Prefix the SQL text with the frame definitions it uses."""
    if not frames:
        return sql
    ctes = ",\n".join(f"{name} AS ({FRAME_SQL[name]})" for name in frames)
    sql = sql.strip()
    if sql[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {ctes},\n{sql[15:]}"
    if sql[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{sql[5:]}"
    return f"WITH {ctes}\n{sql}"


def drawn_sql(seed, *cols) -> str:
    """SQL of ``operators.sampling.drawn``."""
    parts = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in (seed, *cols))
    return f"CAST('0x' || left(md5({parts}), 12) AS BIGINT)"


def query(name: str, sql: str | None = None, frames: str = ""):
    """Register ``fn(f: Frames) -> DataFrame`` under a key; ``sql`` is its twin (None: rows only)."""

    def register(fn: Callable[[Frames], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Frames(spark, folder))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_frames(sql, tuple(frames.split()))
        return fn

    return register
