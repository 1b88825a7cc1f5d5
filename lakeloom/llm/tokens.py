"""Token ids of whole texts by the tokenizers library, through a bounded memo of repeated pieces.

Byte-level BPE never merges across a pre-token border, and there is always one before a single space
or line feed that stands between two visible characters, and between a letter and a full stop or comma.
So such texts are cut there, the distinct pieces of some megabytes of text are looked up together, and the
library encodes those that the worker does not remember. Any other text (runs of blanks, other white space,
text of special tokens) goes to the library whole. The result is the library's own in all cases.
"""

from __future__ import annotations

import functools
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

BYTE_BPE = "byte_bpe_50k.json"
END_ID = 0
MEMO_SIZE = 120_000   # pieces that a dictionary remembers (token_counts)
LONGEST_MEMO = 64     # characters of a remembered piece
REMEMBERED = 400_000  # pieces that an encoder remembers
MERGED = 256          # words that one call of the library merges
GATHERED = 1 << 18    # pieces whose ids are put in a row at a time
latin = re.compile("[\0-\u024f]+").fullmatch  # letters in it are letters in every version of Unicode
LETTERS = "[" + "".join(c for c in map(chr, range(0x250)) if c.isalpha()) + "]+"
UNSAFE = ("  ", " \n", "\n ", "\n\n", "<|")


def tokenizer_path(name: str = BYTE_BPE) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies, and back to the byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places ``begin[i], begin[i] + 1, ...``, ``size[i]`` of each."""
    places = np.repeat(begin - (np.cumsum(size) - size), size)
    places += np.arange(len(places), dtype=places.dtype)
    return places


class Memo:
    """Pieces and their ids in arrays: ``flat[begin[i]:begin[i] + size[i]]`` are the ids of ``pieces[i]``."""

    def __init__(self):
        self.pieces = pa.array([], pa.large_string())
        self.flat, self.begin, self.size, self.met = np.zeros(0, "<u4"), *np.zeros((3, 0), np.int64)

    def look_up(self, pieces: pa.Array, learn) -> np.ndarray:
        """Places of distinct pieces; ``learn`` gives (ids, size of each) of the missing ones."""
        place = pc.index_in(pieces, self.pieces).fill_null(-1).to_numpy().astype(np.int64)
        missing = np.flatnonzero(place < 0)
        if len(missing):
            place[missing] = np.arange(len(self.pieces), len(self.pieces) + len(missing))
            new = pieces.take(pa.array(missing))
            flat, size = learn(new)
            self.begin = np.append(self.begin, len(self.flat) + np.cumsum(size) - size)
            self.pieces = pa.concat_arrays([self.pieces, new])
            self.flat, self.size = np.concatenate([self.flat, flat]), np.append(self.size, size)
            self.met = np.append(self.met, np.zeros(len(missing), np.int64))
        self.met[place] += 1
        return place

    def trim(self) -> None:
        """Drops long pieces and, if there are too many, all but the half that was met most often, and last."""
        keep = pc.utf8_length(self.pieces).to_numpy() <= LONGEST_MEMO
        if len(keep) > REMEMBERED:
            keep[np.argsort(self.met, kind="stable")[:len(keep) - REMEMBERED // 2]] = False
            self.met >>= 1
        if not keep.all():
            self.pieces = self.pieces.filter(pa.array(keep))
            self.begin, self.size, self.met = self.begin[keep], self.size[keep], self.met[keep]
            self.flat = self.flat[ragged(self.begin, self.size)]
            self.begin = np.cumsum(self.size) - self.size


class Encoder:
    """Ids of whole texts as bytes of unsigned 32-bit little-endian numbers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core a task
        self.library = Tokenizer.from_file(path)
        self.memo = Memo()
        self.line = self._library(["\n"])[0]
        self.marks = [self._library([m])[0] for m in ".,"]
        self.merges = Tokenizer(self.library.model)  # the library's merges on pre-tokens that stand on lines
        self.merges.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        letters = {b: c for c, b in byte_letters().items()}
        self.letters = np.array([10 if b == 10 else ord(letters[b]) for b in range(256)], "<u2")
        vocabulary = self.library.get_vocab()
        self.begins = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.begins[[n for t, n in vocabulary.items() if t[:1] == letters[32]]] = True

    def _library(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces without line feeds: one call on all of them as lines, cut at the line feed's id."""
        if not pieces:
            return []
        ids = np.frombuffer(self._library(["\n".join(pieces)])[0], "<u4")
        ends = np.flatnonzero(ids == np.frombuffer(self.line, "<u4")[0])
        if len(self.line) != 4 or len(ends) != len(pieces) - 1:
            return self._library(pieces)
        data, ends = ids.tobytes(), (4 * ends).tolist()
        return [data[a:b] for a, b in zip([0, *(e + 4 for e in ends)], [*ends, len(data)])]

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters behind a blank, and how many each has. A word is one pre-token, the blank begins its first token."""
        lines = self.letters[np.frombuffer((" " + "\n ".join(words)).encode(), np.uint8)].tobytes().decode("utf-16-le")
        ids = np.array(self.merges.encode_batch_fast([lines], add_special_tokens=False)[0].ids, "<u4")
        begin = np.flatnonzero(self.begins[ids])
        if len(begin) == len(words):
            return ids, np.diff(np.append(begin, len(ids)))
        return _flat(self._library([" " + w for w in words]))

    def _others(self, pieces: list[str]) -> list[bytes]:
        """Ids of any pieces; none where there is other white space inside."""
        odd = {p for p in pieces if (p[1:] if p[:1] == "\n" else p).split() != [p.lstrip("\n")]}
        got = dict.fromkeys(odd, b"")
        later = [p for p in pieces if p not in odd and p[0] != "\n"]
        got.update(zip(later, self._pieces([" " + p for p in later])))
        lines = [p for p in pieces if p not in odd and p[0] == "\n"]
        got.update(zip(lines, [self.line + v for v in self._pieces([p[1:] for p in lines])]))
        return [got[p] for p in pieces]

    def _learn(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces in a row, and how many each has."""
        plain = pc.match_substring_regex(pieces, f"^{LETTERS}$").to_numpy(zero_copy_only=False)
        words = pieces.filter(pa.array(plain)).to_pylist()
        found = [self._words(words[i:i + MERGED]) for i in range(0, len(words), MERGED)]
        found.append(_flat(self._others(pieces.filter(pa.array(~plain)).to_pylist())))
        flat, sizes = (np.concatenate(x) for x in zip(*found))
        begin, size = np.zeros((2, len(pieces)), np.int64)
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        begin[order], size[order] = np.cumsum(sizes) - sizes, sizes
        return flat[ragged(begin, size)], size

    def _known(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces in a row, and how many each has; none for a piece with other white space inside."""
        marked = pc.match_substring_regex(pieces, f"^{LETTERS}[.,]$")
        head = pc.if_else(marked, pc.utf8_slice_codeunits(pieces, 0, -1), pieces).dictionary_encode()
        place = self.memo.look_up(head.dictionary, self._learn)[head.indices.to_numpy()]
        marks = [np.flatnonzero(pc.and_(marked, pc.ends_with(pieces, m)).to_numpy(zero_copy_only=False)) for m in ".,"]
        begin, size = self.memo.begin[place], self.memo.size[place]
        own = size.copy()
        for at, mark in zip(marks, self.marks):
            own[at] += len(mark) // 4
        first, flat = np.cumsum(own) - own, np.zeros(int(own.sum()), "<u4")
        flat[ragged(first, size)] = self.memo.flat[ragged(begin, size)]
        for at, mark in zip(marks, self.marks):
            for k, x in enumerate(np.frombuffer(mark, "<u4")):
                flat[first[at] + size[at] + k] = x
        self.memo.trim()
        return flat, own

    def encode(self, texts: list[str]) -> list[bytes]:
        out, cut, whole = [b""] * len(texts), [], []
        for i, t in enumerate(texts):
            if t:
                (whole if t[0] in " \n" or t[-1] in " \n" or any(x in t for x in UNSAFE) else cut).append(i)
        if cut:  # the first piece of a text is one behind a line feed, whose id is taken off
            pieces = pc.split_pattern(pa.array(["\n" + texts[i].replace("\n", " \n") for i in cut], pa.large_string()), " ")
            off, coded = pieces.offsets.to_numpy(), pieces.values.dictionary_encode()
            at = coded.indices.to_numpy()
            flat, size = self._known(coded.dictionary)
            begin, parts = np.cumsum(size) - size, []
            for i in range(0, len(at), GATHERED):
                some = at[i:i + GATHERED]
                parts.append(flat[ragged(begin[some], size[some])].tobytes())
            data = b"".join(parts)
            end, odd = (np.append(0, np.cumsum(x[at]))[off] for x in (size << 2, size == 0))
            for i, a, b, bad in zip(cut, (end[:-1] + len(self.line)).tolist(), end[1:].tolist(), (odd[1:] > odd[:-1]).tolist()):
                if bad:
                    whole.append(i)
                else:
                    out[i] = data[a:b]
        for i, ids in zip(whole, self._library([texts[i] for i in whole])):
            out[i] = ids
        return out


def _flat(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids in a row, and how many each has."""
    return np.frombuffer(b"".join(ids), "<u4"), np.array([len(x) // 4 for x in ids], np.int64)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder a worker process and vocabulary."""
    return Encoder(path)


def encoded(texts: list[str], path: str, end_id: int | None = END_ID) -> list[bytes]:
    """Ids of each text, with the end id."""
    end = b"" if end_id is None else array("I", [end_id]).tobytes()
    return [ids + end for ids in encoder(path).encode(texts)]
