"""Static range asymmetric numeral system over token ids, on numpy arrays.

A block is coded by LANES interleaved states of 64 bits that share one frequency table: token i
belongs to lane i % LANES. The states and the place in the word stream are kept at every CHECKPOINT
steps, with a checksum of the tokens up to the next one, so each segment decodes on its own.
Layout (little-endian): magic, frequency bits, lanes, steps a segment, tokens, segments, words, crc32
of the table, crc32 of the rest; per segment: first word, crc32; states of all segments; words of 32 bits.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

LANES = 128
CHECKPOINT = 256  # steps
MAGIC = b"RNS1"
HEAD = struct.Struct("<4sBxHIIIIII")
LOW = np.uint64(1 << 32)
ROWS = 32  # segments or blocks worked on at a time
U = np.uint64


@dataclass
class Table:
    """Frequencies that sum to 2**bits; ``start`` is their running sum, ``symbol`` its inverse."""

    freq: np.ndarray
    bits: int

    def __post_init__(self):
        self.start = (np.cumsum(self.freq) - self.freq).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(self.freq), dtype=np.int32), self.freq)
        self.check = zlib.crc32(self.freq.astype("<u4").tobytes())


def table(counts: np.ndarray, bits: int = 18) -> Table:
    """Frequencies in proportion to the counts, at least 1 for every id that occurs."""
    counts = [int(c) for c in counts]
    present, total = sum(c > 0 for c in counts), sum(counts)
    bits = max(bits, (4 * max(present, 1) - 1).bit_length())
    room = (1 << bits) - present
    freq = np.array([c * room // total + 1 if c else 0 for c in counts] if total else [1], np.int64)
    freq[int(np.argmax(freq))] += (1 << bits) - int(freq.sum())
    return Table(freq, bits)


def encode(blocks: list[np.ndarray], t: Table) -> list[bytes]:
    """One coded block for each array of ids."""
    order, out = np.argsort([len(b) for b in blocks], kind="stable"), [b""] * len(blocks)
    for i in range(0, len(order), ROWS):
        some = order[i:i + ROWS]
        for j, blob in zip(some, _encode([blocks[k] for k in some], t)):
            out[j] = blob
    return out


def _encode(blocks, t):
    rows, bits = len(blocks), U(t.bits)
    freq = np.append(t.freq.astype(np.uint64), U(1 << t.bits))  # the last: a lane without a token stays as it is
    start = np.append(t.start, U(0))
    most = (freq << U(64 - t.bits)) - U(1)
    pad = len(t.freq)
    steps = max(-(-len(b) // LANES) for b in blocks)
    ids = np.full((rows, steps * LANES), pad, np.int64)
    for r, b in enumerate(blocks):
        ids[r, :len(b)] = b
    ids = ids.reshape(rows, steps, LANES)
    x = np.full((rows, LANES), LOW, np.uint64)
    words, sent, states = np.zeros((rows, steps, LANES), np.uint32), np.zeros((rows, steps, LANES), bool), {}
    for s in range(steps - 1, -1, -1):
        sym = ids[:, s]
        f = freq[sym]
        emit = x > most[sym]
        words[:, s], sent[:, s] = x.astype(np.uint32), emit
        x = np.where(emit, x >> U(32), x)
        q = x // f
        x = (q << bits) + (x - q * f) + start[sym]
        if s % CHECKPOINT == 0:
            states[s] = x
    for r, b in enumerate(blocks):
        own = range(0, -(-len(b) // LANES), CHECKPOINT)
        before = np.concatenate([[0], np.cumsum(sent[r].sum(axis=1))])
        stream = words[r][sent[r]].astype("<u4").tobytes()
        flat = np.asarray(b, "<u4")
        index = b"".join(struct.pack("<II", int(before[s]), zlib.crc32(flat[s * LANES:(s + CHECKPOINT) * LANES].tobytes()))
                         for s in own)
        rest = index + b"".join(states[s].astype("<u8")[r].tobytes() for s in own) + stream
        yield HEAD.pack(MAGIC, t.bits, LANES, CHECKPOINT, len(b), len(own), len(stream) // 4, t.check, zlib.crc32(rest)) + rest


def decode(blobs: list[bytes], t: Table) -> list[np.ndarray]:
    """The ids of each block; raises if a checksum is wrong."""
    out, segments = [], []
    for i, blob in enumerate(blobs):
        magic, bits, lanes, every, n, parts, n_words, check, rest = HEAD.unpack_from(blob)
        if (magic, bits, lanes, check) != (MAGIC, t.bits, LANES, t.check):
            raise ValueError("not a block of this table")
        if zlib.crc32(memoryview(blob)[HEAD.size:]) != rest:
            raise ValueError("checksum of a block is wrong")
        index = np.frombuffer(blob, "<u4", 2 * parts, HEAD.size).reshape(parts, 2)
        at = HEAD.size + 8 * parts
        states = np.frombuffer(blob, "<u8", parts * lanes, at).reshape(parts, lanes)
        stream = np.frombuffer(blob, "<u4", n_words, at + 8 * parts * lanes)
        out.append(np.empty(n, np.uint32))
        for p in range(parts):
            a = p * every * lanes
            segments.append((i, a, min(n, a + every * lanes), states[p], stream[index[p, 0]:], int(index[p, 1])))
    segments.sort(key=lambda s: s[2] - s[1])
    for k in range(0, len(segments), ROWS):
        some = segments[k:k + ROWS]
        for (i, a, b, _, _, crc), ids in zip(some, _decode(some, t)):
            if zlib.crc32(ids.tobytes()) != crc:
                raise ValueError("checksum of a segment is wrong")
            out[i][a:b] = ids
    return out


def _decode(segments, t):
    rows, bits, mask = len(segments), U(t.bits), U((1 << t.bits) - 1)
    size = np.array([b - a for _, a, b, *_ in segments])
    steps = -(-int(size.max()) // LANES)
    x = np.stack([s[3] for s in segments]).astype(np.uint64)
    cut = [s[4][:steps * LANES] for s in segments]
    base = np.cumsum([0] + [len(c) for c in cut[:-1]])
    stream = np.append(np.concatenate(cut), np.uint32(0)).astype(np.uint64)
    freq = t.freq.astype(np.uint64)
    ids = np.zeros((rows, steps, LANES), np.uint32)
    lane = np.arange(LANES)
    for s in range(steps):
        live = (s * LANES + lane)[None, :] < size[:, None]
        slot = x & mask
        sym = t.symbol[slot.astype(np.int64)]
        ids[:, s] = sym
        y = freq[sym] * (x >> bits) + slot - t.start[sym]
        need = live & (y < LOW)
        rank = np.cumsum(need, axis=1)
        at = np.minimum(base[:, None] + rank - 1, len(stream) - 1)
        y = np.where(need, (y << U(32)) | stream[at], y)
        x = np.where(live, y, x)
        base = base + rank[:, -1]
    flat = ids.reshape(rows, -1)
    return [np.ascontiguousarray(flat[r, :size[r]], "<u4") for r in range(rows)]
