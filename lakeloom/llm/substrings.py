"""Substring dedup by relative parsing against blocks of the corpus.

The corpus in doc_id order is its own reference, cut into blocks (chunks). Every window of LENGTH words
has one anchor, the smallest hash of its inner ANCHOR-word runs; the blocks' anchors are the index,
and only windows whose anchor occurs in another block are looked up there by their full hash. The reply
is the earliest place of the window: its block and its word there. A document is then parsed: as long as
the places of successive windows are successive words of one block, the factor grows; else a new factor
begins. So a factor is a phrase of its block, up to collisions of the 64-bit hashes (words of other
blocks are not at hand), but not always the longest one. Every factor has at least LENGTH words,
and both its first and its last window are matches by themselves, so factors end exactly where the
copied words end. The words of all factors are the duplicate spans.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm import arrays
from lakeloom.llm.base import documents, query, staged, words
from lakeloom.llm.chunks import CHUNK_BYTES, Chunks

LENGTH = 20
ANCHOR = 10
NOWHERE = np.int64(np.iinfo(np.int64).max)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    have = 1
    while 2 * have <= width:
        x, have = np.minimum(x[:-have], x[have:]), 2 * have
    return np.minimum(x[:len(x) - (width - have)], x[width - have:]) if have < width else x


class Words:
    """The words of a chunk: their hashes, the texts' borders, and the windows of ``length`` words."""

    def __init__(self, table: pa.Table, length: int, anchor: int):
        self.parts, h, first = [], [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
        for i, strings in arrays.slices(table.column("text")):
            texts, runs = arrays.words_of(strings)
            self.parts.append((i, texts, runs))
            h.append(runs.hashes())
            first.append(runs.first[1:] + first[-1][-1])
        self.first, h = np.concatenate(first), np.concatenate(h)
        self.total = len(h)
        self.starts = arrays.window_starts(self.first, length)
        self.keys = arrays.window_hashes(h, self.starts, length)
        self.anchors = np.zeros(0, np.uint64)
        if len(self.starts):
            inner = arrays.window_hashes(h, np.arange(len(h) - anchor + 1), anchor)
            self.anchors = _sliding_min(inner, length - anchor + 1)[self.starts]


def _elsewhere(keys: np.ndarray, slices: np.ndarray, _) -> np.ndarray:
    """1 for each key that another block holds as well."""
    _, at, times = np.unique(keys, return_inverse=True, return_counts=True)
    return (times[at] > 1).astype(np.uint8), []


def _earliest(keys: np.ndarray, slices: np.ndarray, places: bytes) -> np.ndarray:
    """The first block that holds each key, and the place there."""
    distinct, at = np.unique(keys, return_inverse=True)
    order = np.lexsort((slices, at))  # a block sends each key once
    first = order[np.searchsorted(at[order], np.arange(len(distinct)))]
    return np.stack([slices[first][at], np.frombuffer(places, np.int64)[first][at]], axis=1), []


def _shared_windows(words: Words, replies: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys of the windows whose anchor occurs in another block, and the first place of each here."""
    anchors, at = np.unique(words.anchors, return_inverse=True)
    found = np.frombuffer(replies, np.uint8).astype(bool)
    assert len(found) == len(anchors)
    some = found[at]
    keys, first = np.unique(words.keys[some], return_index=True)
    return keys, words.starts[some][first].astype(np.int64)


def _factors(words: Words, block: np.ndarray, position: np.ndarray) -> list[list[dict]]:
    """Factors of each text: block[w] is the source of window w or NOWHERE, position[w] its first word there."""
    out: list[list[dict]] = [[] for _ in range(len(words.first) - 1)]
    match = np.flatnonzero(block != NOWHERE)
    if not len(match):
        return out
    start, source, place = words.starts[match], block[match], position[match]
    new = np.ones(len(match), bool)
    new[1:] = (np.diff(start) != 1) | (np.diff(source) != 0) | (np.diff(place) != 1)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(match)) - 1
    text = np.searchsorted(words.first, start[begin], "right") - 1
    length = start[end] - start[begin]
    for t, a, n, b, p in zip(text.tolist(), (start[begin] - words.first[text]).tolist(), length.tolist(), source[begin].tolist(),
                             place[begin].tolist()):
        out[t].append({"start": a, "length": n, "block": b, "position": p})
    return out


def dedup(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR,
          chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, Chunks]:
    """(rows, chunks): ``row`` with its text cut, n_words, n_removed, factors (start, length in words, block, first word there).

    Windows are judged on the input. A text without duplicate words stays byte for byte; in another,
    each removed word goes with the white space behind it. A null text has no words and stays null. Of
    repeated rows, and of rows that share an id, the first in order of (doc_id, hash of the text) keeps its words.
    An empty table gives no rows. Call ``chunks.close()`` once the result is written.
    """
    chunks = Chunks(docs, chunk_bytes)

    def anchors(at, table, _):
        return np.unique(Words(table, length, anchor).anchors), None

    def windows(at, table, replies):
        return _shared_windows(Words(table, length, anchor), replies[0])

    found = chunks.ask([], anchors, _elsewhere, "anchors")
    first = chunks.ask([found], windows, _earliest, "windows")
    kind = T.StructType([T.StructField("row", chunks.row_type), T.StructField("n_words", T.LongType()),
                         T.StructField("n_removed", T.LongType()),
                         T.StructField("factors", T.ArrayType(T.StructType.fromDDL("start bigint, length bigint, block bigint, position bigint")))])

    def finish(at, table, replies):
        words = Words(table, length, anchor)
        shared, _ = _shared_windows(words, replies[0])
        source, there = np.frombuffer(replies[1], np.int64).reshape(-1, 2).T
        assert len(source) == len(shared)
        block = np.full(len(words.keys), NOWHERE)
        _, once, same = np.unique(words.keys, return_index=True, return_inverse=True)
        position = words.starts[once][same].astype(np.int64) if len(once) else np.zeros(0, np.int64)
        again = np.ones(len(words.keys), bool)
        again[once] = False
        block[again] = at  # it begins earlier in this very block
        if len(shared):
            place = np.minimum(np.searchsorted(shared, words.keys), len(shared) - 1)
            earlier = (shared[place] == words.keys) & (source[place] < at)
            block[earlier] = source[place][earlier]
            position[earlier] = there[place][earlier]
        gone = arrays.covered(words.starts[block != NOWHERE], length, words.total)
        n_words = np.diff(words.first)
        n_removed = arrays.sums(gone.astype(np.int64), words.first)
        factors = _factors(words, block, position)
        for f in factors:
            for x in f:
                x["length"] += length
        batch_rows = table.combine_chunks()
        seen = 0
        for i, texts, runs in words.parts:
            n = len(texts.off) - 1
            strings = batch_rows.column("text").slice(i, n).combine_chunks()
            cut = gone[seen:seen + len(runs)]
            seen += len(runs)
            if cut.any():
                strings = _without(strings, texts, runs, cut)
            rows = batch_rows.slice(i, n)
            rows = rows.set_column(rows.schema.get_field_index("text"), "text", strings)
            yield pa.RecordBatch.from_arrays(
                [rows.to_struct_array().combine_chunks() if rows.num_rows else pa.array([], rows.to_struct_array().type),
                 pa.array(n_words[i:i + n]), pa.array(n_removed[i:i + n]),
                 pa.array(factors[i:i + n], pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "block", "position")])))],
                ["row", "n_words", "n_removed", "factors"])

    return chunks.apply([found, first], finish, kind), chunks


def _without(strings: pa.Array, texts: arrays.Bytes, runs: arrays.Runs, gone: np.ndarray) -> pa.Array:
    """The texts without the words marked ``gone`` and the white space behind each of them."""
    behind = np.append(runs.begin[1:], len(texts.data))
    last = runs.first[1:][runs.per_text() > 0] - 1
    behind[last] = texts.off[1:][runs.per_text() > 0]  # up to the end of the text behind its last word
    edge = np.zeros(len(texts.data) + 1, np.int32)
    np.add.at(edge, runs.begin[gone], 1)
    np.add.at(edge, behind[gone], -1)
    keep = np.cumsum(edge)[:-1] == 0
    size = np.zeros(len(keep) + 1, np.int64)
    np.cumsum(keep, out=size[1:])
    body = texts.data[keep].tobytes()
    whole = pa.Array.from_buffers(pa.large_string(), len(strings), [None, pa.py_buffer(size[texts.off].tobytes()), pa.py_buffer(body)])
    if strings.null_count:
        whole = pa.compute.if_else(strings.is_valid(), whole, pa.scalar(None, pa.large_string()))
    return whole.cast(strings.type)


ORACLE_10 = r"""
WITH w AS (
  SELECT doc_id, u[1] AS i, u[2] AS w FROM (
    SELECT doc_id, unnest(list_zip(range(len(ws)), ws)) AS u FROM (
      SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents))),
win AS (
  SELECT doc_id, i, string_agg(w, ' ') OVER a AS s, count(*) OVER a AS n FROM w
  WINDOW a AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
later AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1 AS dup FROM win WHERE n = 20),
gone AS (
  SELECT w.doc_id, w.i, w.w, coalesce(bool_or(dup) OVER (
    PARTITION BY w.doc_id ORDER BY w.i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), false) AS cut
  FROM w LEFT JOIN later USING (doc_id, i)),
per AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (cut) AS n_removed,
    string_agg(w, ' ' ORDER BY i) FILTER (NOT cut) AS kept FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN per ON d.doc_id = per.doc_id"""


@query("op10_substring_dedup", ORACLE_10)
def op10_substring_dedup(spark, folder):
    """Words of every document and those removed as part of an earlier passage."""
    rows, chunks = dedup(documents(spark, folder).select("doc_id", "text"))
    kept = F.array_join(words(F.coalesce(F.col("row.text"), F.lit(""))), " ")
    out = staged(rows.select("row.doc_id", "n_words", "n_removed", F.sha2(kept, 256).alias("kept_sha256")), "substrings")
    chunks.close()
    return out
