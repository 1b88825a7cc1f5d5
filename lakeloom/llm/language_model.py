"""Bigram language model with deleted interpolation.

P(w | v) = a2 * c(v, w) / c(v) + a1 * c(w) / N + a0 / (V + 1), with one set of mixture weights for each bucket
of the context count c(v). Counts of the documents outside HELD_FOLD are made; for the weights, the
documents of DELETED_FOLD are deleted from the counts and expectation-maximisation runs on the events
of those documents. The events enter it as a histogram over (bucket, ratio of the bigram to the
uniform estimate, ratio of the unigram to the uniform estimate), of a size that does not depend on the
corpus; every event is in it. Then the deleted documents return to the counts, and all are scored.

Counts stay distributed: chunks ask for the words and word pairs they hold (see ``chunks``).
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm import arrays
from lakeloom.llm.base import documents, query, staged
from lakeloom.llm.chunks import CHUNK_BYTES, Chunks

FOLDS, HELD_FOLD, DELETED_FOLD = 10, 0, 1
ADD = 0.1
BUCKETS = 24              # powers of two of the context count
STEPS = 64                # cells of a log ratio: half-octaves from 2**-4 on
ROUNDS = 60
U = np.uint64
END, START = arrays.mix(np.array([1, 2], np.uint64))  # the end token, and the context of a first word
_PAIR = U(0x8CB92BA72F3D8DD7)


def fold_of(doc_ids: list) -> np.ndarray:
    """crc32 of the id as text, modulo FOLDS; a null id is the text ''."""
    return np.array([zlib.crc32(b"" if d is None else str(d).encode()) % FOLDS for d in doc_ids], np.int64)


class Tokens:
    """Token hashes of the texts of a chunk: words with A-Z folded, then the end token, text by text."""

    def __init__(self, table: pa.Table):
        parts, sizes = [], []
        for _, strings in arrays.slices(table.column("text")):
            _, runs = arrays.words_of(strings)
            parts.append(runs.hashes(lower=True))
            sizes.append(runs.per_text())
        n = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        self.first = np.concatenate([[0], np.cumsum(n + 1)])
        self.word = np.full(int(self.first[-1]), END, np.uint64)
        is_word = np.ones(len(self.word), bool)
        is_word[self.first[1:] - 1] = False
        self.word[is_word] = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        self.context = np.concatenate([[START], self.word[:-1]])[:len(self.word)]
        self.context[self.first[:-1]] = START
        # the lowest bit of a key tells words (0) from word pairs and the start (1)
        pair = arrays.mix(self.context * _PAIR + self.word) | U(1)
        self.fold = np.repeat(fold_of(table.column("doc_id").to_pylist()), n + 1)
        # contexts are asked for as words; the start is a word of no text, counted once a text
        self.keys, at = np.unique(np.concatenate([self.word & ~U(1), pair, [START | U(1)]]), return_inverse=True)
        self.at_word, self.at_pair, start = at[:len(self.word)], at[len(self.word):-1], at[-1]
        self.at_context = np.concatenate([[start], self.at_word[:-1]])[:len(self.word)]
        self.at_context[self.first[:-1]] = start
        self.at_start = start

    def counts(self) -> np.ndarray:
        """Of each key: (occurrences in the kept training folds, in the deleted fold)."""
        out = np.zeros((len(self.keys), 2), np.uint32)
        starts = np.zeros(len(self.word), bool)
        starts[self.first[:-1]] = True
        for c, fold in ((0, (self.fold != HELD_FOLD) & (self.fold != DELETED_FOLD)), (1, self.fold == DELETED_FOLD)):
            for at in (self.at_word[fold], self.at_pair[fold], np.full(int((fold & starts).sum()), self.at_start)):
                out[:, c] += np.bincount(at, minlength=len(self.keys)).astype(np.uint32)
        return out


def _ask(at, table, _):
    tokens = Tokens(table)
    return tokens.keys, tokens.counts()


def _total(keys: np.ndarray, slices: np.ndarray, more: bytes):
    """(kept, deleted) count of each key over all chunks; of the range's words: kept, deleted, distinct kept, distinct."""
    distinct, at = np.unique(keys, return_inverse=True)
    counts = np.frombuffer(more, np.uint32).reshape(-1, 2)
    total = np.zeros((len(distinct), 2), np.uint64)
    for c in range(2):
        np.add.at(total[:, c], at, counts[:, c].astype(np.uint64))
    words = total[(distinct & U(1)) == 0]
    both = words.sum(axis=1)
    return total[at], [int(words[:, 0].sum()), int(words[:, 1].sum()), int((words[:, 0] > 0).sum()), int((both > 0).sum())]


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(context, 1)).astype(np.int64) + (context > 0), BUCKETS - 1)


def _step(ratio: np.ndarray) -> np.ndarray:
    """Cell of a ratio to the uniform estimate; 0 is the ratio 0."""
    return np.where(ratio > 0, np.clip(np.round(2 * np.log2(np.maximum(ratio, 1e-300))) + 9, 1, STEPS - 1), 0).astype(np.int64)


def _ratio(step: np.ndarray) -> np.ndarray:
    return np.where(step > 0, 2.0 ** ((step - 9) / 2), 0.0)


def _estimates(tokens: Tokens, count: np.ndarray, total: float, distinct: float):
    """Bucket of each event, and its bigram and unigram estimates over the uniform one."""
    context = count[tokens.at_context].astype(np.float64)
    bigram = np.where(context > 0, count[tokens.at_pair] / np.maximum(context, 1) * distinct, 0.0)
    unigram = count[tokens.at_word] / max(total, 1) * distinct
    return _bucket(context), bigram, unigram


def learn_weights(cells: list[tuple[int, int, int, int]], rounds: int = ROUNDS) -> np.ndarray:
    """Mixture weights (bigram, unigram, uniform) of each bucket, by expectation-maximisation.

    A bucket without events takes the weights of all events together.
    """
    cells = np.array(cells, np.int64).reshape(-1, 4)
    out = np.zeros((BUCKETS + 1, 3))
    for b in range(BUCKETS, -1, -1):
        own = cells if b == BUCKETS else cells[cells[:, 0] == b]
        if not len(own):
            out[b] = out[BUCKETS] if b < BUCKETS else (0.0, 0.5, 0.5)
            continue
        parts = np.stack([_ratio(own[:, 1]), _ratio(own[:, 2]), np.ones(len(own))], axis=1)
        a = np.full(3, 1 / 3)
        for _ in range(rounds):
            share = parts * a
            share /= share.sum(axis=1, keepdims=True)
            a = (share * own[:, 3:]).sum(axis=0) / own[:, 3].sum()
        out[b] = np.maximum(a, (0.0, 0.0, 1e-6))
        out[b] /= out[b].sum()
    return out[:BUCKETS]


def score(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, Chunks]:
    """(rows, chunks): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    A null or empty text is its end token. Repeated rows count as often as they occur. If no document
    is in the training folds, all counts are 0: the base probability is 1 / (V + 1) with V = 0, and the
    model gives the same. An empty table gives no rows. Call ``chunks.close()`` once the rows are written.
    """
    chunks = Chunks(docs.select("doc_id", "text"), chunk_bytes, ordered=False)
    answers = chunks.ask([], _ask, _total, "counts")
    kept, deleted, kept_words, all_words = chunks.notes(answers).agg(
        *(F.coalesce(F.sum(F.col("note")[i]), F.lit(0)) for i in range(4))).first()

    def events(at, table, replies):
        tokens = Tokens(table)
        count = np.frombuffer(replies[0], np.uint64).reshape(-1, 2)[:, 0]
        bucket, bigram, unigram = _estimates(tokens, count, kept, kept_words + 1)
        cell = (bucket * STEPS + _step(bigram)) * STEPS + _step(unigram)
        cells, n = np.unique(cell[tokens.fold == DELETED_FOLD], return_counts=True)
        yield pa.RecordBatch.from_pydict({"cell": cells.astype(np.int64), "n": n.astype(np.int64)})

    found = chunks.apply([answers], events, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    weights = learn_weights([(c // STEPS ** 2, c // STEPS % STEPS, c % STEPS, n) for c, n in found])  # BUCKETS x STEPS**2 at most
    total = kept + deleted

    def finish(at, table, replies):
        tokens = Tokens(table)
        count = np.frombuffer(replies[0], np.uint64).reshape(-1, 2).sum(axis=1)
        bucket, bigram, unigram = _estimates(tokens, count, total, all_words + 1)
        a = weights[bucket]
        own = count[tokens.at_word]
        base = np.log10((own + ADD) / (total + ADD * (all_words + 1)))
        if total:
            model = np.log10((a[:, 0] * bigram + a[:, 1] * unigram + a[:, 2]) / (all_words + 1))
        else:
            model = base
        text = np.repeat(np.arange(len(tokens.first) - 1), np.diff(tokens.first))
        n = len(tokens.first) - 1
        yield pa.RecordBatch.from_pydict({
            "doc_id": table.column("doc_id").combine_chunks(), "held_out": fold_of(table.column("doc_id").to_pylist()) == HELD_FOLD,
            "n_tokens": np.diff(tokens.first), "n_known": np.bincount(text, weights=own > 0, minlength=n).astype(np.int64),
            "train_tokens": np.full(n, total, np.int64), "base_score": np.bincount(text, weights=base, minlength=n),
            "score": np.bincount(text, weights=model, minlength=n)})

    kind = dict(docs.dtypes)["doc_id"]
    return chunks.apply([answers], finish, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, "
                        "train_tokens bigint, base_score double, score double"), chunks


@query("op7_language_model")
def op7_language_model(spark, folder):
    """Base and interpolated score of every document."""
    rows, chunks = score(documents(spark, folder))
    out = staged(rows, "scores")
    chunks.close()
    return out
