"""The last messages of every conversation, kept by a stream in the JVM and forgotten when a conversation is idle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lakeloom.streaming.sinks import run_batches

BUCKETS = 64


class RecentMessages:
    """State of at most ``keep`` messages a conversation, for conversations heard from within ``idle`` seconds.

    A batch is trimmed to its last messages per conversation before any row is gathered, meets the state partitions of
    its own conversations and writes only these, as one generation; a retried batch overwrites its own. The clock
    is the latest time of any message so far. A conversation that comes back after it was idle starts anew.
    ``compact`` leaves idle state behind. Message number ``order`` tells messages apart; of equal ones the greatest row
    stays. Rows without a conversation, a number or a time are no messages and are left out.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, order: str, at: str, columns: str, keep: int = 20,
                 idle: int = 3600, buckets: int = BUCKETS):
        self.spark, self.root, self.key, self.order, self.at = spark, root, key, order, at
        self.keep, self.idle, self.buckets = keep, idle, buckets
        self.types = {f.name: f.dataType.simpleString() for f in StructType.fromDDL(columns).fields}
        body = ", ".join(f"`{c}`: {t}" for c, t in self.types.items() if c != key)
        self.ddl = f"`{key}` {self.types[key]}, messages array<struct<{body}>>, last_at {self.types[at]}, gen int, bucket int"
        self.done_ddl = f"clock {self.types[at]}, gen int"

    def _read(self, part: str, ddl: str) -> DataFrame:
        path = f"{self.root}/{part}"
        return self.spark.read.schema(ddl).option("basePath", path).parquet(path)

    def _clock(self, before: int | None = None):
        d = self._read("done", self.done_ddl)
        return (d if before is None else d.where(F.col("gen") < before)).agg(F.max("clock")).first()[0]

    def _fresh(self, clock) -> Column:
        return F.lit(True) if clock is None else F.unix_micros(F.col("last_at").cast("timestamp")) >= F.unix_micros(
            F.lit(clock).cast("timestamp")) - self.idle * 1_000_000

    def _last(self, rows: DataFrame) -> DataFrame:
        """Last ``keep`` messages of every conversation; Spark limits the groups before it exchanges them."""
        rest = [c for c in self.types if c not in (self.key, self.order)]
        one = rows.groupBy(self.key, self.order).agg(F.max(F.struct(*rest)).alias("_r")).select(self.key, self.order, "_r.*")
        n = F.row_number().over(W.partitionBy(self.key).orderBy(F.col(self.order).desc()))
        return one.withColumn("_n", n).where(F.col("_n") <= self.keep).drop("_n")

    def apply(self, batch: DataFrame, i: int) -> None:
        """Take in micro batch ``i``; batches count up from 0."""
        rows = batch.select(*[F.col(c).cast(t).alias(c) for c, t in self.types.items()]).dropna(subset=[self.key, self.order, self.at])
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        seen = rows.agg(F.collect_set(bucket).alias("b"), F.max(self.at).alias("m")).first()  # at most ``buckets`` numbers
        clock = self._clock(i) if i else None
        if i and seen.b:
            old = self._newest(self._read("state", self.ddl).where((F.col("gen") < i) & F.col("bucket").isin(seen.b))).where(self._fresh(clock))
            old = old.join(rows.select(self.key).distinct(), self.key, "left_semi").select(self.key, F.explode("messages").alias("_m"))
            rows = rows.unionByName(old.select(self.key, "_m.*"))
        body = F.struct(*[F.col(c) for c in self.types if c != self.key])
        lists = self._last(rows).groupBy(self.key).agg(F.collect_list(body).alias("m"), F.max(self.at).alias("last_at"))
        lists = lists.select(self.key, F.array_sort("m", lambda a, b: F.when(a[self.order] < b[self.order], -1).otherwise(1)).alias("messages"),
                             "last_at", bucket.alias("bucket"))
        lists.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/state/gen={i}")
        now = max((t for t in (clock, seen.m) if t is not None), default=None)
        self.spark.createDataFrame([(now,)], f"clock {self.types[self.at]}").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/done/gen={i}")

    def _newest(self, state: DataFrame) -> DataFrame:
        return state.groupBy(self.key).agg(F.max_by(F.struct("messages", "last_at", "bucket"), "gen").alias("s")).select(self.key, "s.*")

    def state(self) -> DataFrame:
        """All conversations with state that ``compact`` has not left behind; ``live`` tells those that are not idle."""
        return self._newest(self._read("state", self.ddl)).select(self.key, "messages", "last_at", self._fresh(self._clock()).alias("live"))

    def live(self) -> DataFrame:
        return self.state().where("live").drop("live")

    def compact(self, root: str, batch: int) -> RecentMessages:
        """The live state as generation ``batch`` (the newest one taken in) under a new root."""
        fresh = RecentMessages.__new__(RecentMessages)
        fresh.__dict__.update(self.__dict__, root=root)
        clock = self._clock()
        kept = self._newest(self._read("state", self.ddl)).where(self._fresh(clock))
        kept.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/state/gen={batch}")
        self.spark.createDataFrame([(clock,)], f"clock {self.types[self.at]}").coalesce(1).write.mode("overwrite").parquet(f"{root}/done/gen={batch}")
        return fresh


def recent_stream(messages: DataFrame, recent: RecentMessages, checkpoint: str, lag: str | None = None) -> StreamingQuery:
    """Keep the last messages up to date with a stream of messages."""
    return run_batches(messages, checkpoint, lambda batch, i: recent.apply(batch, i), lag)
