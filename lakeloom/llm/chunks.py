"""Chunks: slices of the corpus that are kept whole, ask questions of all others, and use the answers.

The rows of a chunk, about CHUNK_BYTES of text, are stored once as one Arrow table in a row of a table
bucketed by chunk; either in input order or in the order of (doc_id, hash of the text). A chunk asks
with one blob of sorted 64-bit keys for each key range; all blobs of a range meet in one task, which
answers each with a blob in the order asked. Answers are bucketed like the chunks, so texts are
exchanged at most once however often chunks ask. A key occurs once a chunk in what is sent, so a
frequent key costs one entry a chunk, and no task gets it more often than that.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.base import order_key
from lakeloom.session import drop_dir, shared_dir

CHUNK_BYTES = 5 << 20
MOST_CHUNKS = 500_000  # range borders that Spark holds on the driver; beyond, chunks are larger
MOST_RANGES = 4096
ASKED = "range int, slice bigint, keys binary, more binary"
ANSWERED = "range int, slice bigint, notes array<bigint>, reply binary"
REPLIES = "array<struct<range: int, reply: binary>>"


def to_ipc(batches: list[pa.RecordBatch]) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batches[0].schema) as out:
        for b in batches:
            out.write_batch(b)
    return sink.getvalue().to_pybytes()


def from_ipc(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def planes(rows: np.ndarray) -> bytes:
    """Rows of k bytes each as k planes of bytes, which Spark's codecs shrink well; the first byte is k."""
    flat = np.ascontiguousarray(rows).view(np.uint8).reshape(len(rows), -1)
    return bytes([flat.shape[1]]) + flat.T.tobytes()


def rows_of(data: bytes) -> bytes:
    """Back from planes."""
    return np.ascontiguousarray(np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1).T).tobytes() if len(data) > 1 else b""


def split(keys: np.ndarray, ranges: int) -> list[int]:
    """Borders of the key ranges in sorted keys."""
    steps = [((1 << 64) * r) // ranges for r in range(1, ranges)]
    return [0, *np.searchsorted(keys, np.array(steps, np.uint64)).tolist(), len(keys)]


def _store(most: int):
    """Rows of a partition to chunks of at most ``most`` bytes (or one Arrow batch); numbers grow with the order."""

    def run(batches):
        kept, size, number = [], 0, TaskContext.get().partitionId() << 20
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.RecordBatch.from_struct_array(batch.column("row"))
            if kept and size + rows.nbytes > most:
                yield _stored(number, kept)
                kept, size, number = [], 0, number + 1
            at = 0
            while rows.num_rows - at > 0:  # a batch may hold several chunks
                n = rows.num_rows - at
                while n > 1 and rows.slice(at, n).nbytes > most:
                    n = -(-n // 2)
                kept.append(rows.slice(at, n))
                size += kept[-1].nbytes
                at += n
                if at < rows.num_rows:
                    yield _stored(number, kept)
                    kept, size, number = [], 0, number + 1
        if kept:
            yield _stored(number, kept)

    return run


def _stored(number: int, kept: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"slice": pa.array([number], pa.int64()), "body": pa.array([to_ipc(kept)], pa.binary())})


class Chunks:
    """The stored chunks of ``docs`` with all their columns.

    Ordered chunks follow each other by (doc_id, hash of the text), null ids first. ``close`` drops every
    table and folder made for them; call it once the result is written.
    """

    def __init__(self, docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, ordered: bool = True):
        self.spark = docs.sparkSession
        size = docs.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 1
        self.count = min(MOST_CHUNKS, -(-size // chunk_bytes))
        chunk_bytes = max(chunk_bytes, -(-size // self.count))
        self.buckets = min(self.count, int(self.spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))  # chunks may share one
        self.ranges = max(8, min(MOST_RANGES, self.count))
        self.folders: list[str] = []
        self.tables: list[str] = []
        self.row_type = docs.select(F.struct("*").alias("row")).schema["row"].dataType
        rows = docs.select(F.struct("*").alias("row"))
        if ordered:
            rows = rows.select("row", order_key("row.doc_id").alias("k"), F.xxhash64("row.text").alias("th")) \
                .repartitionByRange(self.count, "k", "th").sortWithinPartitions("k", "th").select("row")
        self.table = self._save(rows.mapInArrow(_store(chunk_bytes), "slice bigint, body binary"), "chunks")

    def _save(self, df: DataFrame, purpose: str) -> str:
        name = f"{purpose}_{uuid.uuid4().hex}"
        df.write.bucketBy(self.buckets, "slice").option("path", self._folder(purpose)).option("compression", "zstd") \
            .option("parquet.block.size", 32 << 20).saveAsTable(name)
        self.tables.append(name)
        return name

    def _folder(self, purpose: str) -> str:
        self.folders.append(shared_dir(self.spark, purpose))
        return self.folders[-1]

    def ask(self, before: list[str], question: Callable, reply: Callable, purpose: str) -> str:
        """One round; gives the name of the table of answers.

        ``question(slice, table, replies)`` gives sorted keys and an array of values or None;
        ``reply(keys, slices, values)`` answers the entries of one range, with an array of an item for
        each and a list of numbers about the range. ``replies`` holds those to the rounds in ``before``.
        """
        ranges = self.ranges

        def put(batches):
            for at, table, got in _open(batches, len(before)):
                keys, more = question(at, table, got)
                cut = split(keys, ranges)
                for r, (a, b) in enumerate(zip(cut, cut[1:])):
                    if b > a:
                        yield pa.RecordBatch.from_pydict({
                            "range": pa.array([r], pa.int32()), "slice": pa.array([at], pa.int64()),
                            "keys": [planes(np.diff(keys[a:b], prepend=np.uint64(0)))],
                            "more": [b"" if more is None else planes(more[a:b])]})

        def meet(key, table):
            table = table.sort_by("slice")
            blobs = [np.cumsum(np.frombuffer(rows_of(b), np.uint64), dtype=np.uint64).tobytes()
                     for b in table.column("keys").to_pylist()]
            size = np.array([len(b) // 8 for b in blobs], np.int64)
            got, notes = reply(np.frombuffer(b"".join(blobs), np.uint64), np.repeat(table.column("slice").to_numpy(), size),
                               b"".join(map(rows_of, table.column("more").to_pylist())))
            ends = np.cumsum(size)
            return pa.table({"range": table.column("range"), "slice": table.column("slice"),
                             "notes": pa.array([notes] + [[]] * (len(blobs) - 1), pa.list_(pa.int64())),
                             "reply": [planes(got[a:b]) for a, b in zip(ends - size, ends)]})

        met = self.with_answers(before).mapInArrow(put, ASKED).groupBy("range").applyInArrow(meet, ANSWERED)
        grouped = met.groupBy("slice").agg(
            F.array_sort(F.collect_list(F.struct("range", "reply"))).cast(REPLIES).alias("answers"),
            F.collect_list(F.when(F.size("notes") > 0, F.col("notes"))).alias("notes"))
        return self._save(grouped, purpose)

    def notes(self, answers: str) -> DataFrame:
        """The numbers that ``reply`` gave, a row for each key range."""
        return self.spark.table(answers).select(F.explode("notes").alias("note"))

    def with_answers(self, rounds: list[str]) -> DataFrame:
        """slice, body, and the answers of each round; no exchange, as all tables are bucketed alike."""
        out = self.spark.table(self.table)
        for i, name in enumerate(rounds):
            out = out.join(self.spark.table(name).select("slice", F.col("answers").alias(f"answers{i}")), "slice", "left")
        return out

    def apply(self, rounds: list[str], finish: Callable, schema) -> DataFrame:
        """``finish(slice, table, replies)`` of every chunk: record batches of ``schema``."""

        def run(batches):
            for at, table, got in _open(batches, len(rounds)):
                yield from finish(at, table, got)

        return self.with_answers(rounds).mapInArrow(run, schema)

    def close(self) -> None:
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        for path in self.folders:
            drop_dir(self.spark, path)


def _open(batches, rounds: int) -> Iterator[tuple[int, pa.Table, list[bytes]]]:
    """(slice, its rows, the replies of each round in key order) of each stored chunk."""
    for batch in batches:
        for i in range(batch.num_rows):
            got = [b"".join(rows_of(a["reply"]) for a in batch.column(f"answers{k}")[i].as_py() or []) for k in range(rounds)]
            yield batch.column("slice")[i].as_py(), from_ipc(batch.column("body")[i].as_buffer()), got
