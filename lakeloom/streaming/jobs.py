"""Streaming jobs: index refresh, scheduled embedding, change apply, statistics, conversations."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lakeloom.functions.dates import utc_instant, utc_wall
from lakeloom.functions.text import tokens
from lakeloom.operators.chunking import chunk_lines
from lakeloom.operators.dml import latest_changes, stable_id
from lakeloom.operators.encoders import embed_hashing
from lakeloom.operators.evaluation import daily_columns
from lakeloom.operators.maintained import MaintainedSummary
from lakeloom.sources.tables import SCHEMAS
from lakeloom.streaming.sinks import UpsertLog, run_batches


def table_stream(spark: SparkSession, folder: str, name: str, files_per_batch: int = 1000) -> DataFrame:
    """One table, a file or a folder of files, as a stream with a declared schema and bounded batches."""
    return spark.readStream.schema(SCHEMAS[name]).option("maxFilesPerTrigger", files_per_batch).parquet(
        f"{folder}/{name}.parque[t]")  # as a pattern: a stream's plain path must be a folder


def index_stream(docs: DataFrame, log: UpsertLog, checkpoint: str, lag: str | None = None) -> StreamingQuery:
    """Keep a keyword index up to date: only arriving documents are tokenized."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        log.write(batch.select("doc_id", F.size(tokens("text")).cast("long").alias("n_tokens"),
                               F.array_distinct(tokens("text")).alias("terms")), batch_id)
    return run_batches(docs, checkpoint, handle, lag)


def embed_stream(docs: DataFrame, log: UpsertLog, checkpoint: str, dim: int = 64) -> StreamingQuery:
    """Scheduled run: chunks of documents that arrived since the last run are embedded once."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        c = chunk_lines(batch, ["doc_id"], "text").withColumn("chunk_id", stable_id("doc_id", "chunk_index"))
        log.write(embed_hashing(c, ["chunk_id", "doc_id"], "chunk_text", dim).drop("n_tokens"), batch_id)
    return run_batches(docs, checkpoint, handle)


def change_stream(changes: DataFrame, log: UpsertLog, checkpoint: str, key: str, seq: str = "seq",
                  lag: str | None = None) -> StreamingQuery:
    """Continuous log sync: the last change per key of each batch, deletes kept as rows."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        log.write(latest_changes(batch, key, seq), batch_id)
    return run_batches(changes, checkpoint, handle, lag)


def merged(base: DataFrame, log: UpsertLog, key: str, seq: str = "seq", op: str = "op") -> DataFrame:
    """Base copy with the change log applied; the sequence number decides, not arrival."""
    last = log.latest([seq])
    live = last.where(F.col(op) != "D").select(*base.columns)
    return base.join(last.select(key), key, "left_anti").select(*base.columns).unionByName(live)


def summary_stream(changes: DataFrame, summary: MaintainedSummary, checkpoint: str, lag: str | None = None) -> StreamingQuery:
    """Keep a summary up to date with a change log; generation 0 is what the summary was loaded with."""
    return run_batches(changes, checkpoint, lambda batch, i: summary.apply(batch, i + 1), lag)


def windowed(rows: DataFrame, ts: str, size: str, lateness: str, aggs: list[Column]) -> DataFrame:
    """Tumbling windows over a zone-less time; late rows are accepted for ``lateness``."""
    x = rows.withColumn("_at", utc_instant(ts)).withWatermark("_at", lateness)
    g = x.groupBy(F.window("_at", size)).agg(*aggs)
    return g.select(utc_wall("window.start").alias("window_start"), *[c for c in g.columns if c != "window"])


def windowed_counts(events: DataFrame, ts: str, size: str, lateness: str) -> DataFrame:
    return windowed(events, ts, size, lateness, [F.count(F.lit(1)).alias("n")])


def daily_stats(log_rows: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Daily statistics of the answer log; feedback may arrive a day late."""
    g = windowed(log_rows, "logged_at", "1 day", lateness, daily_columns())
    return g.select(F.to_date("window_start").alias("date"), *[c for c in g.columns if c != "window_start"])


def daily_metric(events: DataFrame, ts: str, value: str, lateness: str = "1 day") -> DataFrame:
    g = windowed(events, ts, "1 day", lateness, [
        F.count(F.lit(1)).alias("n"), F.sum(F.col(value).cast("decimal(18,2)")).alias("total")])
    return g.select(F.to_date("window_start").alias("day"), "n", "total")


def upsert_stream(df: DataFrame, log: UpsertLog, checkpoint: str, lag: str | None = None) -> StreamingQuery:
    """Updated groups of an aggregation go to the log; readers see the newest version of each."""
    return run_batches(df, checkpoint, lambda batch, i: log.write(batch, i), lag, "update")


def conversation_stream(messages: DataFrame, keep: int = 20) -> DataFrame:
    """Growing history per conversation, trimmed to the last ``keep`` messages.

    The state of a conversation never holds more than ``keep`` messages, whatever its length.
    """
    out = "conv_id long, n_kept int, history string"

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept = json.loads(state.get[0]) if state.exists else []
        for b in batches:
            kept += [[int(t), r, x] for t, r, x in zip(b["turn"], b["role"], b["text"])]
            kept = sorted(kept, key=lambda m: m[0])[-keep:]
        text = json.dumps(kept, ensure_ascii=False)
        state.update((text,))
        yield pd.DataFrame({"conv_id": [key[0]], "n_kept": [len(kept)], "history": [text]})

    return messages.groupBy("conv_id").applyInPandasWithState(
        step, out, "history string", "update", GroupStateTimeout.NoTimeout)
