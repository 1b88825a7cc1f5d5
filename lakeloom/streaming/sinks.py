"""Upserts from a stream without a table format.

Every micro batch writes only its own rows into ``batch=N``. A retried batch overwrites its own
folder, so the log is idempotent; readers keep the newest version of a key. ``compact`` folds the
log into one batch when it has grown.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


class UpsertLog:
    def __init__(self, spark: SparkSession, root: str, keys: list[str], schema: StructType):
        self.spark = spark
        self.root = root
        self.keys = keys
        self.schema = StructType(list(schema.fields)).add("batch", "long")

    def write(self, df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/batch={batch}")

    def read_all(self) -> DataFrame:
        return self.spark.read.schema(self.schema).option("basePath", self.root).parquet(self.root)

    def latest(self, order: list[str] = ("batch",)) -> DataFrame:
        """Newest row per key; combines map-side, so a key with many versions costs no skew."""
        log = self.read_all()
        rest = [c for c in log.columns if c not in (*self.keys, "batch")]
        newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")
        return log.groupBy(*self.keys).agg(newest).select(*self.keys, "_r.*")

    def compact(self, target_root: str) -> "UpsertLog":
        """Fold the log into a new root; switch readers over once it has returned."""
        fresh = UpsertLog(self.spark, target_root, self.keys, StructType([f for f in self.schema.fields if f.name != "batch"]))
        fresh.write(self.latest(), 0)
        return fresh


def run_batches(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None],
                lag: str | None = None, mode: str = "append") -> StreamingQuery:
    """Start a stream into ``foreachBatch``.

    ``lag`` is the refresh interval of a continuous job (``"1 minute"``); without it the query
    processes what is there and stops, which is how a scheduled job runs.
    """
    w = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(handle)
    w = w.trigger(processingTime=lag) if lag else w.trigger(availableNow=True)
    return w.start()
