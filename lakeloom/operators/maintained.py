"""A grouped summary kept up to date by changes: what a change takes away is retracted, what it brings is added.

Two tables grow by one generation a batch and are never rewritten. ``state`` holds the newest row of each changed key
beside the row that it replaces, partitioned by a hash of the key; ``totals`` holds the differences of counts and sums,
partitioned by period. A batch reads the state partitions of its own keys and writes totals of the periods it changes;
the rows of a period are never summed again. Readers add the differences up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType, StructType

BUCKETS = 64
DONE = "batch int, floor int, gen int"


class MaintainedSummary:
    """Counts and sums per period and group of the live rows behind a change log.

    ``columns`` (DDL) declares key, period, groups and measures. Measures are integers or decimals, so that a retraction
    is exact. Changes carry these columns, a sequence number and ``op`` (I, U or D); the greatest sequence number of a key
    decides, whatever order batches arrive in, and of equal ones within a batch the greatest row. A key, period, group or measure may be null.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, period: str, by: list[str], measures: list[str],
                 columns: str, buckets: int = BUCKETS):
        self.spark, self.root, self.key, self.period, self.by, self.measures, self.buckets = spark, root, key, period, by, measures, buckets
        types = {f.name: f.dataType for f in StructType.fromDDL(columns).fields}
        inexact = [m for m in measures if not isinstance(types[m], (IntegralType, DecimalType))]
        if inexact:
            raise ValueError(f"cannot be retracted exactly, use integers or decimals: {inexact}")
        body = ", ".join(f"`{c}`: {types[c].simpleString()}" for c in (period, *by, *measures))
        self.state_ddl = f"`{key}` {types[key].simpleString()}, seq bigint, now struct<{body}>, was struct<{body}>, gen int, bucket int"
        groups = ", ".join(f"`{c}` {types[c].simpleString()}" for c in by)
        sums = "".join(f", `sum_{m}` decimal(38,{getattr(types[m], 'scale', 0)}), `n_{m}` bigint" for m in measures)
        self.totals_ddl = f"{groups + ', ' if by else ''}n bigint{sums}, gen int, `{period}` {types[period].simpleString()}"
        self.sum_types = {m: f"decimal(38,{getattr(types[m], 'scale', 0)})" for m in measures}
        self.types = {c: t.simpleString() for c, t in types.items()}
        self.last, self.floor = -1, -1  # newest batch; newest one that is folded with those before it

    def open(self) -> MaintainedSummary:
        """Take up a summary that another session has kept."""
        self.last, self.floor = self._read("done", DONE).agg(F.max("batch"), F.max("floor")).first()
        return self

    def _finish(self, batch: int, floor: int) -> None:
        self.spark.createDataFrame([(batch, floor)], "batch int, floor int").coalesce(1).write.mode("overwrite").parquet(
            f"{self.root}/done/gen={batch}")
        self.last, self.floor = batch, floor

    def _read(self, part: str, ddl: str) -> DataFrame:
        path = f"{self.root}/{part}"
        return self.spark.read.schema(ddl).option("basePath", path).parquet(path)

    def _write(self, df: DataFrame, part: str, gen: int, *by: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by).parquet(f"{self.root}/{part}/gen={gen}")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def apply(self, changes: DataFrame, batch: int, seq: str = "seq", op: str = "op") -> None:
        """Take in one batch. Batches count up; the newest one may be run again, after a failure or by a replay."""
        if batch < self.last:
            raise ValueError(f"batch {batch} comes after batch {self.last}")
        if batch <= self.floor:  # a replay of what is folded already
            return
        changes = changes.select(*[F.col(c).cast(t).alias(c) for c, t in self.types.items()], F.col(seq).alias("_seq"), F.col(op).alias("_op"))
        body = F.struct(self.period, *self.by, *self.measures)
        change = F.struct(F.col("_seq").cast("bigint").alias("seq"), F.col("_op").alias("op"), body.alias("row"))
        last = changes.groupBy(self.key).agg(F.max(change).alias("c")).withColumn("bucket", self._bucket())
        last = last.select(self.key, "bucket", "c.seq", F.when(F.col("c.op") != "D", F.col("c.row")).alias("now"))
        touched = [] if batch == 0 else [r[0] for r in changes.select(self._bucket()).distinct().collect()]  # at most ``buckets``
        if touched:
            old = self._read("state", self.state_ddl).where((F.col("gen") < batch) & F.col("bucket").isin(touched))
            old = old.groupBy(self.key).agg(F.max_by(F.struct("seq", "now"), "seq").alias("o")).select(F.col(self.key).alias("_k"), "o")
            rows = last.join(old, F.col(self.key).eqNullSafe(F.col("_k")), "left").where("o IS NULL OR seq > o.seq")
            rows = rows.select(self.key, "seq", "now", F.col("o.now").alias("was"), "bucket")
        else:
            rows = last.select(self.key, "seq", "now", F.lit(None).cast(last.schema["now"].dataType).alias("was"), "bucket")
        self._write(rows.hint("rebalance", "bucket"), "state", batch, "bucket")
        fresh = self._read("state", self.state_ddl).where(F.col("gen") == batch)
        self._write(self._differences(fresh), "totals", batch, self.period)
        self._finish(batch, self.floor)

    def _differences(self, rows: DataFrame) -> DataFrame:
        both = F.array(F.struct(F.lit(1).alias("sign"), F.col("now").alias("r")), F.struct(F.lit(-1).alias("sign"), F.col("was").alias("r")))
        rows = rows.select(F.explode(both).alias("x")).where("x.r IS NOT NULL").select("x.sign", "x.r.*")
        aggs = [F.sum("sign").alias("n")]
        for m in self.measures:
            signed = F.when(F.col("sign") == 1, F.col(m)).otherwise(-F.col(m))
            aggs += [F.sum(signed).cast(self.sum_types[m]).alias(f"sum_{m}"),
                     F.coalesce(F.sum(F.when(F.col(m).isNotNull(), F.col("sign"))), F.lit(0)).alias(f"n_{m}")]
        d = rows.groupBy(self.period, *self.by).agg(*aggs)
        moved = F.col("n") != 0
        for m in self.measures:
            moved = moved | (F.col(f"n_{m}") != 0) | (F.coalesce(F.col(f"sum_{m}"), F.lit(0)) != 0)
        return d.where(moved)

    def _totals(self) -> DataFrame:
        return self._read("totals", self.totals_ddl).where(F.col("gen") <= self.last)

    def changed_periods(self, batch: int) -> DataFrame:
        """Periods whose totals a batch has moved."""
        return self._totals().where(F.col("gen") == batch).select(self.period).distinct()

    def summary(self, where: Column | None = None) -> DataFrame:
        """Period, groups, ``n`` and ``sum_*``; a filter on the period reads only its folders. A sum without any value is null."""
        t = self._totals() if where is None else self._totals().where(where)
        sums = [F.sum(c).alias(c) for m in self.measures for c in (f"sum_{m}", f"n_{m}")]
        g = t.groupBy(self.period, *self.by).agg(F.sum("n").alias("n"), *sums).where("n > 0")
        return g.select(self.period, *self.by, "n", *[
            F.when(F.col(f"n_{m}") > 0, F.col(f"sum_{m}")).cast(self.sum_types[m]).alias(f"sum_{m}") for m in self.measures])

    def compact(self, root: str) -> MaintainedSummary:
        """The same summary as one generation under a new root; switch readers over once it has returned."""
        fresh = MaintainedSummary.__new__(MaintainedSummary)
        fresh.__dict__.update(self.__dict__, root=root)
        state = self._read("state", self.state_ddl).where(F.col("gen") <= self.last)
        newest = state.groupBy(self.key, "bucket").agg(F.max_by(F.struct("seq", "now"), "seq").alias("o"))
        newest = newest.select(self.key, "o.seq", "o.now", F.lit(None).cast(state.schema["was"].dataType).alias("was"), "bucket")
        fresh._write(newest.hint("rebalance", "bucket"), "state", self.last, "bucket")
        whole = self._totals().groupBy(self.period, *self.by).agg(
            F.sum("n").alias("n"), *[F.sum(f"{c}_{m}").cast(self.sum_types[m] if c == "sum" else "bigint").alias(f"{c}_{m}")
                                     for m in self.measures for c in ("sum", "n")])
        fresh._write(whole.where("n > 0"), "totals", self.last, self.period)
        fresh._finish(self.last, self.last)
        return fresh
