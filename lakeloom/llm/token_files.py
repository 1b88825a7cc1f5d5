"""Token files: ids of all documents in ascending doc_id, range coded in independent blocks.

A folder holds ``table`` (the shared frequencies) and ``blocks``: containers written by Spark's own
writer, a row for each block with its place in the order, the documents it holds and the coded ids.
Any block, and any segment of a block, decodes alone. A document is never split over blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.llm import rans, tokens
from lakeloom.llm.arrays import slices
from lakeloom.llm.base import documents, order_key, query, staged, texts
from lakeloom.llm.order import bounds_of, slice_of
from lakeloom.session import drop_dir, shared_dir

BLOCK_TOKENS = 1 << 16
STORE = "slice int, block int, before bigint, doc_ids array<bigint>, doc_tokens array<bigint>, ids binary"
CODED = "slice int, block int, before bigint, n_tokens bigint, doc_ids array<bigint>, doc_tokens array<bigint>, coded binary"


COUNTS = -1  # slice number of the rows that hold id counts (doc_ids: ids, doc_tokens: their counts)


def _row(at: int, block: int, before: int, docs, sizes, ids: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "slice": pa.array([at], pa.int32()), "block": pa.array([block], pa.int32()), "before": pa.array([before], pa.int64()),
        "doc_ids": pa.array([docs], pa.list_(pa.int64())), "doc_tokens": pa.array([sizes], pa.list_(pa.int64())),
        "ids": pa.array([ids], pa.binary())})


def _to_blocks(path: str, end_id: int):
    """Sorted documents to rows of STORE: whole documents until a block is full; then the counts of all ids."""

    def run(batches):
        at, block, before, docs, ids, size, total = None, 0, 0, [], [], 0, np.zeros(0, np.int64)
        for batch in batches:
            slice_no, doc_id = batch.column("slice").to_pylist(), batch.column("doc_id").to_pylist()
            for i, strings in slices(batch.column("text")):
                for k, got in enumerate(tokens.encoded(strings.to_pylist(), path, end_id), i):
                    new = slice_no[k] != at
                    if docs and (new or size >= BLOCK_TOKENS):
                        flat = b"".join(ids)
                        total = _added(total, flat)
                        yield _row(at, block, before, docs, [len(x) // 4 for x in ids], flat)
                        block, before, docs, ids, size = block + 1, before + size, [], [], 0
                    if new:
                        at, block, before = slice_no[k], 0, 0
                    docs.append(doc_id[k])
                    ids.append(got)
                    size += len(got) // 4
        if docs:
            flat = b"".join(ids)
            total = _added(total, flat)
            yield _row(at, block, before, docs, [len(x) // 4 for x in ids], flat)
        some = np.flatnonzero(total)
        yield _row(COUNTS, 0, 0, some.tolist(), total[some].tolist(), b"")

    return run


def _added(total: np.ndarray, ids: bytes) -> np.ndarray:
    got = np.bincount(np.frombuffer(ids, "<u4"), minlength=len(total))
    got[:len(total)] += total
    return got


def write_tokens(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = tokens.END_ID) -> None:
    """Tokenise, order and code all documents into ``path``.

    A null text is empty (its end id only); rows that share a doc_id follow each other by text, a
    null id comes first; an empty table writes a table and no block.
    """
    spark = docs.sparkSession
    vocabulary = vocabulary or tokens.tokenizer_path()
    ordered = texts(docs).withColumn("k", order_key()).withColumn("slice", slice_of(bounds_of(docs))) \
        .repartition("slice").sortWithinPartitions("slice", "k", "text").select("slice", "doc_id", "text")
    store_path = shared_dir(spark, "token-store")
    store = staged(ordered.mapInArrow(_to_blocks(vocabulary, end_id), STORE), "token-store", store_path)
    counts = store.where(F.col("slice") == COUNTS).select(F.explode(F.arrays_zip("doc_ids", "doc_tokens")).alias("c")) \
        .groupBy("c.doc_ids").agg(F.sum("c.doc_tokens")).collect()
    freq = np.zeros(max((i for i, _ in counts), default=0) + 1, np.int64)  # a number for each id of the vocabulary
    for i, n in counts:
        freq[i] = n
    table = rans.table(freq)
    spark.createDataFrame([(table.bits, table.freq.tolist())], "bits int, freq array<bigint>") \
        .coalesce(1).write.parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast(table.freq)
    bits = table.bits

    def code(batches):
        t = rans.Table(shared.value, bits)
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            for a in range(0, len(ids), rans.ROWS):
                part = batch.slice(a, rans.ROWS)
                arrays = [np.frombuffer(b, "<u4") for b in ids[a:a + rans.ROWS]]
                yield pa.RecordBatch.from_pydict({
                    "slice": part.column("slice"), "block": part.column("block"), "before": part.column("before"),
                    "n_tokens": [len(x) for x in arrays],
                    "doc_ids": part.column("doc_ids"), "doc_tokens": part.column("doc_tokens"),
                    "coded": pa.array(rans.encode(arrays, t), pa.binary())})

    store.where(F.col("slice") != COUNTS).mapInArrow(code, CODED).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    drop_dir(spark, store_path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (unsigned 32-bit little-endian)."""
    bits, freq = spark.read.parquet(f"{path}/table").first()
    shared = spark.sparkContext.broadcast(np.array(freq, np.int64))
    blocks = spark.read.schema(CODED).parquet(f"{path}/blocks")

    def expand(batches):
        t = rans.Table(shared.value, bits)
        for batch in batches:
            for a in range(0, batch.num_rows, rans.ROWS):
                part = batch.slice(a, rans.ROWS)
                decoded = rans.decode(part.column("coded").to_pylist(), t)
                for s, before, docs, sizes, ids in zip(*(part.column(c).to_pylist() for c in (
                        "slice", "before", "doc_ids", "doc_tokens")), decoded):
                    ends = np.cumsum(sizes)
                    begin = ends - sizes
                    yield pa.RecordBatch.from_pydict({
                        "slice": pa.array([s] * len(docs), pa.int32()),
                        "doc_id": pa.array(docs, pa.int64()), "within": begin + before, "n_tokens": np.asarray(sizes, np.int64),
                        "ids": pa.array([ids[x:y].tobytes() for x, y in zip(begin, ends)], pa.binary())})

    starts = blocks.groupBy("slice").agg(F.sum("n_tokens").alias("n")).select("slice", F.coalesce(
        F.sum("n").over(Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    rows = blocks.mapInArrow(expand, "slice int, doc_id bigint, within bigint, n_tokens bigint, ids binary")
    return rows.join(F.broadcast(starts), "slice").select(  # MOST_SLICES rows
        "doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids")


@query("op5_token_files")
def op5_token_files(spark, folder):
    """Ids of all documents, written to files and read back."""
    path = shared_dir(spark, "token-files")
    write_tokens(documents(spark, folder), path)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").cast("long").alias("ids_crc32"))
