"""Sinks: append, full refresh, versioned refresh, archive export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from lakeloom.operators.dml import apply_defaults


def insert_select(df: DataFrame, path: str, columns: list[str], defaults: dict[str, Column] | None = None) -> None:
    """Append query rows to a table folder; columns not selected take their defaults."""
    apply_defaults(df, defaults or {}).select(*columns).write.mode("append").parquet(path)


def append_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Append to a catalog table, creating it on first use."""
    writer = df.write.mode("append")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def truncate_and_load(df: DataFrame, path: str) -> None:
    """Replace all rows. The query must not read the folder it replaces; use ``VersionedTable`` then."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def export_parquet(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Archive in object storage, one folder per partition value.

    The rebalance hint brings the rows of a value together, so that files are few and large, and
    lets AQE split a value that holds many rows over several tasks.
    """
    df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)


class VersionedTable:
    """Table whose refresh reads the current version and writes the next one.

    A version counts only once its job has committed (``_SUCCESS``), so a failed refresh leaves
    the old version in use. Works on every file system Hadoop knows.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def _fs(self):
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        return jvm, root, root.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def current(self) -> int | None:
        jvm, root, fs = self._fs()
        if not fs.exists(root):
            return None
        done = []
        for st in fs.listStatus(root):
            name = st.getPath().getName()
            if name.startswith("version=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                done.append(int(name.split("=")[1]))
        return max(done, default=None)

    def read(self) -> DataFrame | None:
        v = self.current()
        return None if v is None else self.spark.read.parquet(f"{self.root}/version={v}")

    def write(self, df: DataFrame) -> int:
        v = (self.current() or 0) + 1
        df.write.mode("overwrite").parquet(f"{self.root}/version={v}")
        return v
