"""Bounded parallel scan of a database table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class JdbcScan:
    """Settings of a partitioned read; ``num_partitions`` bounds the open connections."""

    url: str
    table: str
    partition_column: str
    lower: int
    upper: int
    num_partitions: int = 8
    fetch_size: int = 10_000
    row_limit: int | None = None

    def ranges(self) -> list[tuple[int | None, int | None]]:
        """Half-open key ranges, open at both ends so that no row is lost."""
        n = max(1, min(self.num_partitions, self.upper - self.lower + 1))
        cuts = [self.lower + (self.upper - self.lower + 1) * i // n for i in range(1, n)]
        return list(zip([None, *cuts], [*cuts, None]))

    def predicates(self) -> list[str]:
        c = self.partition_column
        out = []
        for lo, hi in self.ranges():
            parts = [f"{c} >= {lo}"] if lo is not None else []
            parts += [f"{c} < {hi}"] if hi is not None else []
            text = " AND ".join(parts) or "1 = 1"
            out.append(f"({text} OR {c} IS NULL)" if lo is None else text)
        return out

    def source(self) -> str:
        if self.row_limit is None:
            return self.table
        return f"(SELECT * FROM {self.table} ORDER BY {self.partition_column} LIMIT {self.row_limit}) t"


def jdbc_scan(spark: SparkSession, cfg: JdbcScan) -> DataFrame:
    return spark.read.jdbc(cfg.url, cfg.source(), predicates=cfg.predicates(),
                           properties={"fetchsize": str(cfg.fetch_size)})


def plan_scan(df: DataFrame, table: str, key: str, num_partitions: int, url: str = "") -> JdbcScan:
    """Scan settings from the key bounds of a table."""
    lo, hi = df.agg(F.min(key), F.max(key)).first()
    return JdbcScan(url, table, key, lo or 0, hi or 0, num_partitions)


def partition_profile(df: DataFrame, cfg: JdbcScan) -> DataFrame:
    """Rows each connection would read, in one pass."""
    preds = cfg.predicates()
    case = F.lit(None).cast("int")
    for i, p in reversed(list(enumerate(preds))):
        case = F.when(F.expr(p), F.lit(i)).otherwise(case)
    return df.groupBy(case.alias("partition_no")).agg(F.count(F.lit(1)).alias("n"))
