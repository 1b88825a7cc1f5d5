"""Token counts with the whole-token shortcut.

Offline, every vocabulary string that closes a word is encoded alone; those that give exactly one
token are proven. A pre-token that is a proven string counts one without any merge; only the rest go
through the merges, each distinct piece once while a worker remembers it.
"""

from __future__ import annotations

import json
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeloom.llm.arrays import slices
from lakeloom.llm.base import documents, query, texts
from lakeloom.llm.tokens import LONGEST_MEMO, MEMO_SIZE, byte_letters, latin, tokenizer_path

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
WORD_END = "</w>"


def proven_words(path: str) -> frozenset[str]:
    """Vocabulary strings that the library encodes alone, as a text of their own, in one token."""
    library, back = Tokenizer.from_file(path), byte_letters()
    found = []
    for piece in library.get_vocab():
        if not piece.endswith(WORD_END):
            continue
        try:
            found.append(bytes(back[c] for c in piece[:-len(WORD_END)]).decode())
        except (KeyError, UnicodeDecodeError):
            continue
    found = [w for w in found if w and w.split() == [w]]
    encodings = library.encode_batch_fast(found, add_special_tokens=False)
    return frozenset(w for w, e in zip(found, encodings) if len(e.ids) == 1)


class Counter(dict):
    """Tokens of a piece of text between blanks."""

    def __init__(self, path: str, proven: frozenset[str]):
        super().__init__()
        self.library, self.proven = Tokenizer.from_file(path), proven
        self.letters = {b: c for c, b in byte_letters().items()}
        self.whole = {"".join(self.letters[b] for b in w.encode()) for w in proven}
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self._restart()

    def _restart(self):
        self.clear()
        self.update(dict.fromkeys(self.proven, 1))
        self[""] = 0

    def __missing__(self, piece: str) -> int:
        low = piece.lower()
        if low.isalpha() and latin(low) and is_normalized("NFC", piece):  # letters only: one pre-token
            plain = low if low.isascii() else low.encode().decode("latin-1").translate(self.letters)
            n = 1 if low in self.proven else len(self.library.model.tokenize(plain))
        elif len(piece) > 1 and piece[-1] in ".," and piece[-1] in self.proven and low[-2:-1].isalpha() and latin(piece):
            n = self[piece[:-1]] + 1  # a letter and a full stop or comma never share a pre-token
        elif any(s in piece for s in self.special):  # the library's own handling of special strings
            n = len(self.library.encode(piece, add_special_tokens=False).ids)
        else:
            text = self.library.normalizer.normalize_str(piece)
            parts = [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]
            n = sum(1 if p in self.whole else len(self.library.model.tokenize(p)) for p in parts)
        if len(piece) <= LONGEST_MEMO:
            if len(self) > MEMO_SIZE + len(self.proven):
                self._restart()
            self[piece] = n
        return n

    def count(self, text: str) -> int:
        # white space is dropped before any merge, and no pre-token crosses it
        return sum([self[p] for p in text.replace("\n", " ").split(" ")])


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row; a null text is empty and has no token."""
    path = path or tokenizer_path(VOCABULARY)
    proven = docs.sparkSession.sparkContext.broadcast(json.dumps(sorted(proven_words(path))))  # part of the vocabulary

    def run(batches):
        own = _own(path, proven)
        for batch in batches:
            for i, strings in slices(batch.column("text")):
                n = [own.count(t) for t in strings.to_pylist()]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").slice(i, len(n)), "n_tokens": np.array(n, np.int64),
                    "n_bytes": batch.column("n_bytes").slice(i, len(n))})

    rows = texts(docs).withColumn("n_bytes", F.octet_length("text").cast("long"))
    out = rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, n_tokens bigint, n_bytes bigint")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


_COUNTERS: dict[str, Counter] = {}


def _own(path: str, proven) -> Counter:
    """The counter of this worker process."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path, frozenset(json.loads(proven.value)))
    return _COUNTERS[path]


@query("op6_token_counts")
def op6_token_counts(spark, folder):
    """Bytes and tokens of every document."""
    return count_tokens(documents(spark, folder))
