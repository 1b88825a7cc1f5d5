"""Alignment of two tokenizers by sparse incidence matrices.

Tokenizer A (byte-level BPE) and B (pieces with byte fallback) cut the same bytes. Over the bytes of a chunk of
documents, a token is a row of a 0/1 matrix in CSR form: its columns are the bytes it covers, the byte it ends
at, or its group (the stretch between two offsets at which tokens of both end). A row-wise Gustavson product
A Bᵀ then holds an entry for each linked pair of token occurrences: over covered bytes the overlap links with
the number of shared bytes, over end bytes the pairs that end together, over groups the pairs of one group.

How often two ids are linked is counted over the whole corpus: each chunk sends its distinct id pairs with their
counts, Spark sums them by pair, and each chunk gets the sums of its own pairs back. Texts are read and
tokenised once; tokens never travel, only distinct pairs of a chunk do, so a frequent pair is one row a chunk.
A task holds one chunk at a time, however many it has: row groups of staged chunks are cut by their bytes, and
a chunk meets the sums of its pairs alone.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeloom.llm.arrays import Bytes, slices
from lakeloom.llm.base import documents, query, staged, texts
from lakeloom.llm.chunks import planes, rows_of
from lakeloom.llm.tokens import BYTE_BPE, byte_letters, latin, tokenizer_path
from lakeloom.session import drop_dir, shared_dir

RANKS = "byte_bpe_50k.tiktoken"  # the vocabulary of BYTE_BPE as ranks
PIECES = "piece_bpe_32k.model"
WORK = 1 << 22                   # entries of a product that are expanded at a time
CHUNK_TEXT = 2 << 20             # bytes of text of a chunk; a longer text is a chunk of its own
CUT_BLOCK = 8 << 20              # bytes of a row group of staged chunks, or one chunk
PART_TEXT = 1 << 20              # bytes of text that are tokenised at a time, or one text


class Csr:
    """A sparse matrix by rows: ``indices[indptr[i]:indptr[i + 1]]`` are the columns of row i, ``values`` its entries."""

    def __init__(self, indptr: np.ndarray, indices: np.ndarray, columns: int, values: np.ndarray | None = None):
        self.indptr, self.indices, self.columns, self.values = indptr, indices, columns, values

    @property
    def rows(self) -> int:
        return len(self.indptr) - 1

    def transposed(self) -> Csr:
        order = np.argsort(self.indices, kind="stable")
        indptr = np.zeros(self.columns + 1, np.int64)
        np.cumsum(np.bincount(self.indices, minlength=self.columns), out=indptr[1:])
        own = np.repeat(np.arange(self.rows), np.diff(self.indptr))
        return Csr(indptr, own[order], self.rows, None if self.values is None else self.values[order])


def products(a: Csr, b: Csr, work: int = WORK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Entries (row, column, value) of the product a b by Gustavson's rows, some rows at a time.

    Row i is the sum of the rows of ``b`` that the entries of row i of ``a`` name. At most ``work``
    terms are held at once, or those of one row.
    """
    size = np.diff(b.indptr)
    terms = np.zeros(len(a.indices) + 1, np.int64)
    np.cumsum(size[a.indices], out=terms[1:])
    upto = terms[a.indptr]
    first = 0
    while first < a.rows:
        last = max(first + 1, int(np.searchsorted(upto, upto[first] + work, "right")) - 1)
        lo, hi = a.indptr[first], a.indptr[last]
        inner = a.indices[lo:hi]
        n = size[inner]
        row = np.repeat(np.repeat(np.arange(first, last), np.diff(a.indptr[first:last + 1])), n)
        at = np.arange(int(n.sum())) + np.repeat(b.indptr[inner] - (np.cumsum(n) - n), n)
        column = b.indices[at]
        value = np.ones(len(at), np.int64) if b.values is None else b.values[at]
        if a.values is not None:
            value = value * np.repeat(a.values[lo:hi], n)
        key = row * b.columns + column
        if len(key) and (np.diff(key) < 0).any():
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
        new = np.ones(len(key), bool)
        new[1:] = np.diff(key) != 0
        begin = np.flatnonzero(new)
        if len(begin):
            yield key[begin] // b.columns, key[begin] % b.columns, np.add.reduceat(value, begin)
        first = last


class Cuts:
    """The tokens of one tokenizer over the joined bytes of some texts: ids, borders, first token of each text."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, first: np.ndarray):
        self.ids, self.first = ids, first
        self.border = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(sizes, out=self.border[1:])

    @property
    def ends(self) -> np.ndarray:
        return self.border[1:]

    def by_byte(self) -> Csr:
        """Token x byte."""
        return Csr(self.border, np.arange(self.border[-1]), int(self.border[-1]))

    def by_end(self) -> Csr:
        """Token x its last byte."""
        return Csr(np.arange(len(self.ids) + 1), self.ends - 1, int(self.border[-1]))

    def by_group(self, groups: np.ndarray) -> Csr:
        """Token x group; ``groups`` are the ascending ends of the groups."""
        return Csr(np.arange(len(self.ids) + 1), np.searchsorted(groups, self.ends), len(groups))


def group_ends(a: Cuts, b: Cuts) -> np.ndarray:
    """Byte offsets at which tokens of both end."""
    return np.intersect1d(a.ends, b.ends, assume_unique=True)


INCIDENCE = {"overlap": lambda c, g: c.by_byte(), "end": lambda c, g: c.by_end(), "group": lambda c, g: c.by_group(g)}


def links(a: Cuts, b: Cuts, kind: str = "overlap") -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(A token, B token, value) of all linked pairs: ``overlap`` (shared bytes), ``end`` or ``group`` (1)."""
    groups = group_ends(a, b) if kind == "group" else None
    return products(INCIDENCE[kind](a, groups), INCIDENCE[kind](b, groups).transposed())


class _Vocabulary:
    """The bytes of each id."""

    def __init__(self, pieces: list[bytes]):
        self.size = np.array([len(p) for p in pieces], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        n = self.size[ids]
        return self.flat[np.arange(int(n.sum())) + np.repeat(self.begin[ids] - (np.cumsum(n) - n), n)]


class Pair:
    """The two tokenizers.

    A's ids are those of the vocabulary file for ``tokenizers``. Where all characters are up to U+024F, the
    same vocabulary as ranks gives them faster; what counts as a letter or a digit may differ beyond.
    """

    def __init__(self, vocabulary: str, ranks: str, pieces: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core a task
        import public_tokenizers
        self.library = Tokenizer.from_file(vocabulary)
        self.library.encode_special_tokens = True
        with open(ranks, "rb") as f:
            table = {base64.b64decode(p): int(n) for p, n in map(bytes.split, f)}
        self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        back = byte_letters()
        found = [b""] * self.library.get_vocab_size()
        for p, n in self.library.get_vocab().items():
            found[n] = bytes(back[c] for c in p) if all(c in back for c in p) else p.encode()
        self.a = _Vocabulary(found)
        self.sp = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.b = _Vocabulary([bytes([int(p[3:-1], 16)]) if self.sp.is_byte(i) else p.replace("▁", " ").encode()
                              for i in range(self.sp.get_piece_size()) for p in [self.sp.id_to_piece(i)]])

    def ids_a(self, text: str) -> np.ndarray:
        if latin(text):
            return self.ranks.encode_to_numpy(text, disallowed_special=())
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def cuts(self, strings: list[str]) -> tuple[Cuts, Cuts, np.ndarray]:
        """Tokens of both over all texts that both cut without a change of bytes, and which texts these are."""
        full = [" " + t for t in strings]
        data = [np.frombuffer(t.encode(), np.uint8) for t in full]
        left = [self.ids_a(t) if len(t) > 1 else np.zeros(0, np.uint32) for t in full]
        right = [np.array(x, np.int64) for x in self.sp.encode(strings, num_threads=1)] if strings else []
        whole = self._same(self.a, left, data) & self._same(self.b, right, data)
        some = np.flatnonzero(whole).tolist()
        return self._cuts(self.a, [left[i] for i in some]), self._cuts(self.b, [right[i] for i in some]), whole

    @staticmethod
    def _same(of: _Vocabulary, ids: list[np.ndarray], data: list[np.ndarray]) -> np.ndarray:
        """Which texts are the joined bytes of their tokens; a text of the added blank alone counts as none."""
        size = np.array([len(d) for d in data], np.int64)
        flat = np.concatenate([np.zeros(0, np.int64), *ids]).astype(np.int64)
        first = np.zeros(len(ids) + 1, np.int64)
        np.cumsum([len(x) for x in ids], out=first[1:])
        border = np.zeros(len(flat) + 1, np.int64)
        np.cumsum(of.size[flat], out=border[1:])
        ok = (np.diff(border[first]) == size) & (size > 1)
        joined = of.joined(flat)
        for i in np.flatnonzero(ok).tolist():
            ok[i] = np.array_equal(joined[border[first[i]]:border[first[i + 1]]], data[i])
        return ok

    @staticmethod
    def _cuts(of: _Vocabulary, ids: list[np.ndarray]) -> Cuts:
        flat = np.concatenate([np.zeros(0, np.int64), *ids]).astype(np.int64)
        first = np.zeros(len(ids) + 1, np.int64)
        np.cumsum([len(x) for x in ids], out=first[1:])
        return Cuts(flat, of.size[flat], first)


@functools.lru_cache(maxsize=1)
def pair(vocabulary: str, ranks: str, pieces: str) -> Pair:
    """One pair a worker process."""
    return Pair(vocabulary, ranks, pieces)


_DECIMALS = np.frombuffer("".join(str(i).ljust(8, "\0") for i in range(100_000)).encode(), np.uint8).reshape(-1, 8)


def group_strings(a: Cuts, b: Cuts, groups: np.ndarray) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of each text: the ids of each group in order, from the group incidence."""
    ga, gb = a.by_group(groups).transposed(), b.by_group(groups).transposed()
    place_a = np.arange(len(a.ids)) + np.repeat(gb.indptr[:-1], np.diff(ga.indptr))
    place_b = np.arange(len(b.ids)) + np.repeat(ga.indptr[1:], np.diff(gb.indptr))
    ids = np.zeros(len(a.ids) + len(b.ids), np.int64)
    mark = np.full(len(ids), ord(","), np.uint8)
    ids[place_a], ids[place_b] = a.ids[ga.indices], b.ids[gb.indices]
    mark[place_a[ga.indptr[1:] - 1]], mark[place_b[gb.indptr[1:] - 1]] = ord("|"), ord(";")
    letters = _DECIMALS[ids]  # a copy
    length = (letters != 0).sum(axis=1)
    letters[np.arange(len(ids)), length] = mark
    flat = letters[letters != 0].tobytes()
    end = np.zeros(len(ids) + 1, np.int64)
    np.cumsum(length + 1, out=end[1:])
    at = end[a.first + b.first].tolist()
    return [flat[x:y - 1] for x, y in zip(at, at[1:])]


CUT = ("chunk bigint, doc_ids array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, "
       "groups_sha256 array<string>, pairs array<bigint>, counts array<bigint>, at binary")
ALIGNED = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")


def _aligned(both: Pair, strings: list[str], kind: str) -> tuple[dict[str, np.ndarray], list[str], np.ndarray]:
    """Numbers and group digests of each text, and the id pairs of all links in order."""
    a, b, whole = both.cuts(strings)
    groups = group_ends(a, b)
    found = [(x, b.ids[y] << 32 | a.ids[x]) for x, y, _ in links(a, b, kind)]
    left, ids = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*found) if found else ((), ())))
    some = np.flatnonzero(whole)
    per = {"n_a": np.diff(a.first), "n_b": np.diff(b.first), "n_links": np.diff(np.searchsorted(left, a.first)),
           "n_groups": np.diff(np.searchsorted(groups, a.border[a.first], "right"))}
    full = {k: np.zeros(len(strings), np.int64) for k in per}
    for k, v in per.items():
        full[k][some] = v
    sha = [""] * len(strings)
    for k, text in zip(some.tolist(), group_strings(a, b, groups)):
        sha[k] = hashlib.sha256(text).hexdigest()
    return full, sha, ids


def _aligner(files: tuple[str, str, str], kind: str):
    def run(batches):
        both, number = pair(*files), TaskContext.get().partitionId() << 32
        for batch in batches:
            for i, strings in slices(batch.column("text"), CHUNK_TEXT):
                parts = [_aligned(both, part.to_pylist(), kind) for _, part in slices(strings, PART_TEXT)]
                pairs, at, counts = np.unique(np.concatenate([ids for _, _, ids in parts]), return_inverse=True, return_counts=True)
                ids = batch.column("doc_id").slice(i, len(strings)).to_pylist()
                yield pa.RecordBatch.from_pydict({
                    "chunk": pa.array([number], pa.int64()), "doc_ids": pa.array([ids], pa.list_(pa.int64())),
                    **{k: pa.array([np.concatenate([x[k] for x, _, _ in parts])], pa.list_(pa.int64())) for k in ("n_a", "n_b", "n_groups", "n_links")},
                    "groups_sha256": pa.array([[x for _, sha, _ in parts for x in sha]], pa.list_(pa.string())),
                    "pairs": pa.array([pairs], pa.list_(pa.int64())), "counts": pa.array([counts], pa.list_(pa.int64())),
                    "at": pa.array([planes(at.astype(np.uint32))], pa.binary())})
                number += 1

    return run


def _answered(cut, answers):
    """Sums of the corpus-wide counts over the links of each document of one chunk."""
    row = {c: cut.column(c)[0] for c in cut.schema.names}
    value = np.zeros(answers.num_rows, np.int64)
    value[answers.column("pos").to_numpy()] = answers.column("value").to_numpy()
    at = np.frombuffer(rows_of(row["at"].as_py()), np.uint32)
    first = np.append(0, np.cumsum(row["n_links"].values.to_numpy()))
    sums = [np.append(0, np.cumsum(x))[first] for x in ((value & 1)[at], (value >> 1)[at])]
    return pa.Table.from_arrays(
        [row["doc_ids"].values, *(row[c].values for c in ("n_a", "n_b", "n_groups", "n_links")), pa.array(np.diff(sums[0]), pa.int64()),
         pa.array(np.diff(sums[1]), pa.int64()), row["groups_sha256"].values],
        [c.split()[0] for c in ALIGNED.split(", ")])


def align(docs: DataFrame, kind: str = "end", vocabulary: str | None = None, ranks: str | None = None,
          pieces: str | None = None) -> tuple[DataFrame, DataFrame, list[str]]:
    """(documents, pairs, folders): a row for each document, and the corpus-wide count of every linked id pair.

    Documents: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose count is the highest of their B id), count_sum,
    groups_sha256. Pairs: a, b, n, best. ``kind`` chooses the links (see ``links``; ``group`` is quadratic in the
    size of a group). A null or empty text, and one whose bytes a tokenizer changes, has no tokens: zeros and
    ''. Rows that share an id and repeated rows are documents of their own; other columns are not read; an empty
    table gives no rows. Drop the folders once the result is written.
    """
    spark = docs.sparkSession
    files = (vocabulary or tokenizer_path(BYTE_BPE), ranks or tokenizer_path(RANKS), pieces or tokenizer_path(PIECES))
    folders = [shared_dir(spark, "aligned"), shared_dir(spark, "id-pairs")]
    rows = texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    # Parquet's writer looks at its size after 100 rows first, and a reader holds a row group: here every row is large
    cut = staged(rows.mapInArrow(_aligner(files, kind), CUT), "aligned", folders[0],
                 **{"parquet.block.size": CUT_BLOCK, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1})
    count = cut.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p")).groupBy(F.col("p.pairs").alias("pair")) \
        .agg(F.sum("p.counts").alias("n"))
    count = staged(count.withColumn("b", F.expr("int(pair >> 32)")), "id-pairs", folders[1])
    most = count.groupBy("b").agg(F.max("n").alias("most"))
    count = count.join(F.broadcast(most), "b")  # a row for each id of B's vocabulary
    value = F.col("n") * 2 + (F.col("n") == F.col("most")).cast("long")
    asked = cut.select("chunk", F.posexplode("pairs").alias("pos", "pair"))
    answers = asked.join(count.select("pair", value.alias("value")), "pair").select(F.col("chunk").alias("of"), "pos", "value")
    out = cut.drop("pairs", "counts").groupBy("chunk").cogroup(answers.groupBy("of")).applyInArrow(_answered, ALIGNED)
    return out, count.select(F.expr("int(pair & 4294967295)").alias("a"), "b", "n", (F.col("n") == F.col("most")).alias("best")), folders


@query("op13_token_alignment")
def op13_token_alignment(spark, folder):
    """Links of the two tokenizers in every document; nulls, odd texts and empty tables as in ``align``."""
    out, _, folders = align(documents(spark, folder))
    path = shared_dir(spark, "alignment")
    try:
        return staged(out, "alignment", path)
    finally:
        for f in folders:
            drop_dir(spark, f)
