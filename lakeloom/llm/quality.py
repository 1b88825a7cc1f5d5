"""Quality rules: log-likelihood ratio of hashed n-grams between trusted texts and the whole corpus.

Words and word pairs are hashed into a fixed number of bins. One multinomial is counted over the
trusted documents, one over all documents; a text scores the mean log ratio of its n-grams. Few trusted
texts miss many n-grams of good ones, so the trusted texts are scored as well, each without its own
counts, and the ratios are scaled down until at most MOST_LOST of them are below the threshold. A last
pass scores every document against the finished table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm import arrays
from lakeloom.llm.base import documents, query

BIN_BITS = 14
SMOOTHING = 1.0            # added to every bin of the raw counts
PRIOR = 0.1                # pseudo-counts as a share of the trusted counts, spread like the raw corpus
THRESHOLD = -0.06          # mean log ratio below which a text is rejected
MOST_SENT = 200_000        # trusted ids that are broadcast; more meet the documents by a shuffle
FEWEST_WORDS = 20
MOST_LOST = 0.01           # share of left-out trusted texts that may score below the threshold
FEWEST_TRUSTED = 20        # trusted texts of FEWEST_WORDS below which no text is judged by its score
MOST_REPEATED = 30         # percent of words in repeated windows
REPEAT_WINDOW = 8

SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def _grams(words: arrays.Runs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins of all words and word pairs, and the text of each."""
    h = words.hashes()
    starts = arrays.window_starts(words.first, 2)
    pairs = arrays.window_hashes(h, starts, 2)
    text = words.text_of()
    down = np.uint64(64 - BIN_BITS)
    return (np.concatenate([arrays.mix(h) >> down, pairs >> down]).astype(np.int64),
            h, np.concatenate([text, text[starts]]))


def _count(batches):
    raw, good = np.zeros(1 << BIN_BITS, np.int64), np.zeros(1 << BIN_BITS, np.int64)
    for batch in batches:
        trusted = np.asarray(batch.column("trusted").fill_null(False))
        for i, strings in arrays.slices(batch.column("text")):
            _, words = arrays.words_of(strings)
            bins, _, text = _grams(words)
            raw += np.bincount(bins, minlength=1 << BIN_BITS)
            good += np.bincount(bins[trusted[i + text]], minlength=1 << BIN_BITS)
    some = np.flatnonzero(raw)
    yield pa.RecordBatch.from_pydict({"bin": some, "raw": raw[some], "good": good[some]})


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids labelled good and not toxic (null counts as not), each once."""
    return labels.where("quality = 1 and coalesce(toxic, 0) <> 1 and doc_id is not null").select("doc_id").distinct()


def log_ratios(docs: DataFrame, labels: DataFrame, prior: float = PRIOR) -> np.ndarray:
    """Scaled log ratio of trusted to raw probability of each bin (2**BIN_BITS numbers), counted over all documents.

    The scale brings the MOST_LOST quantile of the left-out scores of trusted texts up to THRESHOLD; it
    is 1 where that is not below. With less than FEWEST_TRUSTED trusted texts all ratios are 0.
    """
    good = trusted_ids(labels).withColumn("trusted", F.lit(True))
    if good.count() <= MOST_SENT:
        good = F.broadcast(good)
    both = docs.select("doc_id", "text").join(good, "doc_id", "left").select("text", "trusted")
    counts = both.mapInArrow(_count, "bin bigint, raw bigint, good bigint") \
        .groupBy("bin").agg(F.sum("raw"), F.sum("good")).collect()  # a row a bin
    raw, trusted = np.zeros(1 << BIN_BITS), np.zeros(1 << BIN_BITS)
    for b, r, g in counts:
        raw[b], trusted[b] = r, g
    if not trusted.sum():
        return np.zeros(1 << BIN_BITS)  # nothing is trusted: no evidence against any text
    q = (raw + SMOOTHING) / (raw + SMOOTHING).sum()
    left_out = both.where("trusted").select("text").mapInArrow(_left_out(docs, trusted, q, prior), "score double")
    # exact, so that verdicts do not depend on how partitions merge; an entry for each score of a trusted text
    n, low = left_out.agg(F.count("score"), F.expr(f"percentile_disc({MOST_LOST!r}) WITHIN GROUP (ORDER BY score)")).first()
    if n < FEWEST_TRUSTED:
        return np.zeros(1 << BIN_BITS)
    ratios = np.log((trusted / trusted.sum() + prior * q) / (1 + prior)) - np.log(q)
    return ratios * min(1.0, THRESHOLD / min(low, THRESHOLD))


def _left_out(docs: DataFrame, trusted: np.ndarray, q: np.ndarray, prior: float):
    """Scores of trusted texts of FEWEST_WORDS or more, each without its own counts."""
    table = docs.sparkSession.sparkContext.broadcast((trusted, q))  # twice 2**BIN_BITS doubles

    def run(batches):
        trusted, q = table.value
        whole = trusted.sum()
        for batch in batches:
            for _, strings in arrays.slices(batch.column("text")):
                _, words = arrays.words_of(strings)
                bins, _, text = _grams(words)
                grams = np.bincount(text, minlength=len(strings))
                _, at, times = np.unique((text << BIN_BITS) | bins, return_inverse=True, return_counts=True)
                others = np.maximum(whole - grams, 1)[text]
                p = ((trusted[bins] - times[at]) / others + prior * q[bins]) / (1 + prior)
                total = np.bincount(text, weights=np.log(p) - np.log(q[bins]), minlength=len(strings))
                some = (words.per_text() >= FEWEST_WORDS) & (grams < whole)
                yield pa.RecordBatch.from_pydict({"score": total[some] / grams[some]})

    return run


def measures(strings: pa.Array, ratios: np.ndarray) -> dict[str, np.ndarray]:
    """Counts and score of each text."""
    texts, words = arrays.words_of(strings)
    bins, h, gram_text = _grams(words)
    n_words = words.per_text()
    grams = np.bincount(gram_text, minlength=len(strings))
    total = np.bincount(gram_text, weights=ratios[bins], minlength=len(strings))
    starts = arrays.window_starts(words.first, REPEAT_WINDOW)
    keys = arrays.salted(arrays.window_hashes(h, starts, REPEAT_WINDOW), words.text_of()[starts])
    _, at, times = np.unique(keys, return_inverse=True, return_counts=True)
    repeated = arrays.covered(starts[times[at] > 1], REPEAT_WINDOW, len(words))
    lines = arrays.Runs(texts, texts.data == 10)
    inside = np.zeros(len(texts.data) + 1, np.int64)
    np.cumsum(~arrays.GAP[texts.data], out=inside[1:])
    with_word = inside[lines.end] > inside[lines.begin]
    line_text = lines.text_of()
    line_keys = arrays.salted(lines.hashes(), line_text)[with_word]
    _, once = np.unique(line_keys, return_index=True)
    again = np.ones(len(line_keys), bool)
    again[once] = False
    letters = (texts.data & 0xC0) != 0x80
    n_repeat = arrays.sums(repeated.astype(np.int64), words.first)
    return {
        "n_words": n_words, "word_chars": texts.count(letters & ~arrays.GAP[texts.data]),
        "n_symbols": texts.count(SYMBOL[texts.data]),
        "n_dup_lines": np.bincount(line_text[with_word][again], minlength=len(strings)),
        "n_repeat_words": n_repeat,
        "base_failed": (n_words < FEWEST_WORDS) | (100 * n_repeat > MOST_REPEATED * n_words),
        "score": np.where(grams > 0, total / np.maximum(grams, 1), -math.inf),
    }


MEASURES = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
            "base_failed boolean, score double")


def scored(docs: DataFrame, ratios: np.ndarray, threshold: float = THRESHOLD,
           carry: tuple[str, ...] | None = None) -> DataFrame:
    """Every row of ``docs`` as struct ``row`` (columns ``carry``, default all) with measures, score, ``kept``.

    A null or empty text has no words, fails the base rules and scores minus infinity. Equal texts
    get equal verdicts, repeated rows stay rows, an empty table gives no rows.
    """
    table = docs.sparkSession.sparkContext.broadcast(ratios)  # 2**BIN_BITS doubles

    def score(batches):
        for batch in batches:
            rows = batch.column("row")
            column = rows.field("text") if carry is None else batch.column("text")
            for i, strings in arrays.slices(column):
                got = measures(strings, table.value)
                yield pa.RecordBatch.from_pydict({"row": rows.slice(i, len(strings)), **got})

    rows = docs.select(F.struct(*(carry or docs.columns)).alias("row"), *(["text"] if carry else []))
    out = T.StructType([rows.schema["row"], *T.StructType.fromDDL(MEASURES)])
    return rows.mapInArrow(score, out).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= threshold))


@query("op4_quality_rules")
def op4_quality_rules(spark, folder):
    """Counts, base rules and verdict of every document."""
    docs = documents(spark, folder).select("doc_id", "text")
    ratios = log_ratios(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return scored(docs, ratios, carry=("doc_id",)).select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                       "n_repeat_words", "base_failed", "kept", "score")
