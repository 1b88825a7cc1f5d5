"""Array work on the texts of one Arrow batch: words, lines, their hashes, windows of words.

Everything is done on whole byte buffers, so no Python object is made for a word. All hashes are
64-bit and depend on nothing but the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20  # text that is worked on at a time; a longer text is a slice of its own

GAP = np.zeros(256, bool)
GAP[[32, 9, 10, 11, 12, 13]] = True
_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15 | 3)      # odd, 3 mod 4
_WINDOW = np.uint64(0xD6E8FEB86659FD93)        # odd
_WINDOW_INV = np.uint64(pow(int(_WINDOW), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)[:n]


def slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, strings) of consecutive rows with about ``limit`` bytes; nulls become empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1] if n else np.zeros(1)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + limit, "right")) - 1)
        yield i, column.slice(i, min(j, n) - i)
        i = min(j, n)


class Bytes:
    """The bytes of some texts: ``data`` and the ``n + 1`` text borders ``off``."""

    def __init__(self, strings: pa.Array):
        n = len(strings)
        off = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset:strings.offset + n + 1]
        body = strings.buffers()[2]
        data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
        self.data, self.off = data[off[0]:off[-1]], off - off[0]

    def count(self, mask: np.ndarray) -> np.ndarray:
        """True bytes of each text."""
        total = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=total[1:])
        return np.diff(total[self.off])


class Runs:
    """Maximal runs of bytes outside ``gap``, never across a text border: words or lines.

    ``first`` holds for each text the number of its first run (and the total at the end).
    """

    def __init__(self, texts: Bytes, gap: np.ndarray):
        data, off, n = texts.data, texts.off, len(texts.data)
        inside = ~gap
        at_start, at_end = np.ones(n, bool), np.ones(n, bool)
        at_start[1:], at_end[:-1] = gap[:-1], gap[1:]
        at_start[off[:-1][off[:-1] < n]] = True
        at_end[off[1:][off[1:] > 0] - 1] = True
        self.begin = np.flatnonzero(inside & at_start)
        self.end = np.flatnonzero(inside & at_end) + 1
        self.first = np.searchsorted(self.begin, off)
        self._data, self._gap = data, gap

    def __len__(self) -> int:
        return len(self.begin)

    def per_text(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.per_text())

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A hash of the bytes of each run; ``lower`` folds A-Z."""
        if not len(self):
            return np.zeros(0, np.uint64)
        data = self._data
        if lower:
            data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        length = self.end - self.begin
        span = np.diff(np.append(self.begin, len(data)))
        place = np.arange(self.begin[0], len(data)) - np.repeat(self.begin, span)
        place[self._gap[self.begin[0]:]] = 0
        value = _BYTE[data]
        value[self._gap] = 0
        value = value[self.begin[0]:] * powers(_STEP, int(length.max()))[place]
        total = np.add.reduceat(value, self.begin - self.begin[0])
        return mix(total + length.astype(np.uint64) * _WINDOW)


def words_of(strings: pa.Array) -> tuple[Bytes, Runs]:
    texts = Bytes(strings)
    return texts, Runs(texts, GAP[texts.data])


def window_starts(first: np.ndarray, width: int) -> np.ndarray:
    """Numbers of the words at which a window of ``width`` words of one text begins."""
    total = int(first[-1])
    ok = np.ones(total, bool)
    size = np.diff(first)
    for k in range(1, width):  # the last width - 1 words of a text begin no window
        ok[(first[1:] - k)[size >= k]] = False
    return np.flatnonzero(ok)


def window_hashes(h: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` hashes from each start, by differences of one running sum."""
    n = len(h)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(h * powers(_WINDOW, n), out=total[1:], dtype=np.uint64)
    back = powers(_WINDOW_INV, n)
    return mix((total[starts + width] - total[starts]) * back[starts])


def covered(starts: np.ndarray, width: int, total: int) -> np.ndarray:
    """Which of ``total`` words lie in a window that begins at one of ``starts``."""
    edge = np.zeros(total + width + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return np.cumsum(edge)[:total] > 0


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each text, exact for counts and in one fixed order for floats."""
    total = np.zeros(len(values) + 1, values.dtype if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def salted(h: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hash of (text number, hash), to tell repeats inside one text."""
    return mix(h + mix(text.astype(np.uint64) + np.uint64(1)) * _WINDOW)
