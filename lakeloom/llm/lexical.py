"""Ranked lexical search over bit-sliced Bloom signatures.

The index keeps documents in blocks. A document's terms are entered in a Bloom row of the width of its block; for a
term that occurs often, (term, level) is entered for each of LEVELS up to its count. The rows of a block are
stored by bit: one bitmap over its documents for each bit position. The bitmaps of a term, ANDed, overestimate the
documents that hold it (that often), so weighted sums of them bound every document's score from above. A search

1. takes the documents of the highest bounds of each item and scores them exactly: the tenth best score is a
   threshold that no result can be below;
2. scores exactly every document whose bound reaches the threshold; all others are provably excluded.

Signatures, document frequencies and lengths cover every document and whole texts. Texts are read once to index
them and again for the two sets of documents that are scored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm import arrays
from lakeloom.llm.base import LEAST_LONG, documents, order_key, query, staged
from lakeloom.session import drop_dir, shared_dir

RESULTS = 10
FIRST = 24                  # documents of highest bounds that are scored first; any number from RESULTS on gives the same result
LEVELS = (1, 2, 3, 4, 6, 8, 12, 16, 32)
BITS = 8                    # of a row for each entry, rounded up to a power of two of them
PROBES = 4
BLOCK_CELLS = 1 << 24       # bits of a block, at least one document
BLOCK_ROWS = 4096
PENDING = 4 << 20           # entries a task holds back to fill its blocks
COUNTED = 1 << 20           # distinct terms whose frequencies a task sums up before it hands them on
BLOCK_TERMS = 200_000       # terms of the items that are searched together
SEND = 1_000_000            # (item, text) pairs that may travel to the texts; beyond, texts are shuffled to them

_TERM_GAP = np.zeros(256, bool)
for _a, _b in ((0, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    _TERM_GAP[_a:_b + 1] = True
_SALT = [np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64)) for level in range(len(LEVELS))]
INDEX = ("kind string, width bigint, k array<bigint>, th array<bigint>, n array<bigint>, bits binary")


def term_counts(strings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(term hash, text, occurrences) of distinct terms by text and hash, and all occurrences of each text."""
    body = arrays.Bytes(strings)
    runs = arrays.Runs(body, _TERM_GAP[body.data])
    h, owner = runs.hashes(lower=True), runs.text_of()
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (np.diff(owner) != 0) | (h[1:] != h[:-1])
    begin = np.flatnonzero(new)
    return h[begin], owner[begin], np.diff(np.append(begin, len(h))), runs.per_text()


def places(terms: np.ndarray, level: int, width: int) -> np.ndarray:
    """Bit positions of each (term, level): PROBES columns."""
    x = arrays.mix(terms + _SALT[level])
    step = arrays.mix(x) | np.uint64(1)
    return ((x[:, None] + step[:, None] * np.arange(PROBES, dtype=np.uint64)) >> np.uint64(8)) % np.uint64(width)


class _Class:
    """Documents that wait for a block of their width."""

    def __init__(self):
        self.k, self.th, self.n, self.terms, self.times, self.size, self.held = [], [], [], [], [], [], 0


def _block(width: int, c: _Class) -> pa.RecordBatch:
    docs = len(c.k)
    owner = np.repeat(np.arange(docs), c.size)
    terms, times = np.concatenate(c.terms), np.concatenate(c.times)
    cells = np.zeros((width, -(-docs // 8) * 8), bool)
    for level, least in enumerate(LEVELS):
        some = times >= least
        at = places(terms[some], level, width)
        for p in range(PROBES):
            cells[at[:, p], owner[some]] = True
    return _row("block", width, c.k, c.th, c.n, np.packbits(cells, axis=1).tobytes())


def _row(kind: str, width: int, k, th, n, bits: bytes) -> pa.RecordBatch:
    longs = pa.list_(pa.int64())
    return pa.RecordBatch.from_pydict({
        "kind": [kind], "width": pa.array([width], pa.int64()), "k": pa.array([k], longs), "th": pa.array([th], longs),
        "n": pa.array([n], longs), "bits": pa.array([bits], pa.binary())})


def _index(batches):
    """Blocks, then ``df`` rows (th: terms, n: documents of this task that hold them) and a ``sum`` row (n: documents, terms)."""
    classes: dict[int, _Class] = {}
    held, seen, pending, totals = 0, [], 0, np.zeros(2, np.int64)

    def flush(width):
        nonlocal held
        c = classes.pop(width)
        held -= c.held
        return _block(width, c)

    def counted():
        terms, at = np.unique(np.concatenate([t for t, _ in seen]), return_inverse=True)
        return terms, np.bincount(at, weights=np.concatenate([n for _, n in seen])).astype(np.int64)

    for batch in batches:
        for i, strings in arrays.slices(batch.column("text")):
            terms, owner, times, n = term_counts(strings)
            k, th = (batch.column(c).slice(i, len(n)).to_pylist() for c in ("k", "th"))
            totals += [int((n > 0).sum()), int(n.sum())]
            got, count = np.unique(terms, return_counts=True)
            seen.append((got, count))
            pending += len(got)
            if pending > COUNTED:
                seen = [counted()]
                pending = len(seen[0][0])
                if pending > COUNTED // 2:
                    yield _row("df", 0, [], seen[0][0].view(np.int64), seen[0][1], b"")
                    seen, pending = [], 0
            entries = np.bincount(owner, weights=np.searchsorted(LEVELS, times, "right"), minlength=len(n)).astype(np.int64)
            edge = np.searchsorted(owner, np.arange(len(n) + 1))
            for d in np.flatnonzero(n).tolist():
                width = BITS << max(3, int(entries[d] - 1).bit_length())
                c = classes.setdefault(width, _Class())
                a, b = edge[d], edge[d + 1]
                c.k.append(k[d]), c.th.append(th[d]), c.n.append(int(n[d])), c.size.append(b - a)
                c.terms.append(terms[a:b].copy()), c.times.append(times[a:b].copy())
                c.held += b - a
                held += b - a
                if len(c.k) >= min(BLOCK_ROWS, max(1, BLOCK_CELLS // width)):
                    yield flush(width)
                while held > PENDING:
                    yield flush(max(classes, key=lambda w: classes[w].held))
    for width in list(classes):
        yield flush(width)
    if seen:
        got, count = counted()
        yield _row("df", 0, [], got.view(np.int64), count, b"")
    yield _row("sum", 0, [], [], totals, b"")


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(order_key().alias("k"), F.xxhash64(text).alias("th"), text.alias("text"))


@dataclass
class Index:
    """The index of some documents; ``docs`` still holds their texts."""

    docs: DataFrame
    blocks: DataFrame     # width, k, th, n, bits
    frequencies: DataFrame  # term, df
    rows: int             # documents that hold a term
    terms: int            # all their terms
    folders: list[str]

    def close(self) -> None:
        for f in self.folders:
            drop_dir(self.docs.sparkSession, f)


def build(docs: DataFrame) -> Index:
    """Index all documents; ``close`` it once the last result is written.

    A null text has no terms; documents without terms are in no block. Rows that share an id and repeated rows
    are documents of their own; a null id counts as the least long. Other columns are not read.
    """
    spark = docs.sparkSession
    folders = [shared_dir(spark, "signatures"), shared_dir(spark, "frequencies")]
    index = staged(_keyed(docs).mapInArrow(_index, INDEX), "signatures", folders[0])
    found = index.where("kind = 'sum'").select(F.sum(F.col("n")[0]), F.sum(F.col("n")[1])).first()
    df = index.where("kind = 'df'").select(F.explode(F.arrays_zip("th", "n")).alias("t")) \
        .groupBy(F.col("t.th").alias("term")).agg(F.sum("t.n").alias("df"))
    df = staged(df, "frequencies", folders[1])
    return Index(docs, index.where("kind = 'block'").drop("kind"), df, found[0] or 0, found[1] or 0, folders)


def _item_terms(batches):
    for batch in batches:
        for i, strings in arrays.slices(batch.column("text")):
            terms, owner, times, _ = term_counts(strings)
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id").slice(i, len(strings)).take(pa.array(owner)), batch.column("ih").slice(i, len(strings)).take(pa.array(owner)),
                 pa.array(terms.view(np.int64)), pa.array(times)], ["item_id", "ih", "term", "times"])


class Items:
    """Some items: their terms by item, with weight times occurrences."""

    def __init__(self, rows, n_docs: int):
        rows = sorted(rows, key=lambda r: (r.item_id is not None, r.item_id or 0, r.ih, r.term))
        self.item = sorted({(r.item_id, r.ih) for r in rows}, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        number = {x: i for i, x in enumerate(self.item)}
        self.terms, at = np.unique(np.array([r.term for r in rows], np.int64).view(np.uint64), return_inverse=True)
        weight = np.array([r.times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r.df + 1))) for r in rows], np.int64)
        first = np.searchsorted([number[r.item_id, r.ih] for r in rows], np.arange(len(self.item) + 1))
        self.own = [(at[a:b], weight[a:b]) for a, b in zip(first, first[1:])]  # numbers in ``terms``, weights

    def __len__(self) -> int:
        return len(self.item)


def length_norm(n: np.ndarray, rows: int, terms: int) -> np.ndarray:
    """m of documents of n terms: 25 + (75 n rows) div terms."""
    if len(n) and int(n.max()) * rows * 75 < 1 << 62:
        return 25 + 75 * n * rows // terms
    return np.array([25 + 75 * int(x) * rows // terms for x in n], np.int64)


def saturation(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def bounds(items: Items, width: int, n: np.ndarray, bits: np.ndarray, rows: int, terms: int):
    """(item number, upper bounds of the scores of the documents of a block) for each item that has any above 0."""
    bits = bits.reshape(width, -1)
    docs = len(n)
    m = length_norm(n, rows, terms)
    alive = np.arange(len(items.terms))
    held: list[tuple[np.ndarray, np.ndarray]] = []  # for each level: bitmaps, and the row of each term in them or -1
    before = None
    for level in range(len(LEVELS)):
        maps = np.empty((len(alive), bits.shape[1]), np.uint8)
        for a in range(0, len(alive), 4096):
            some = alive[a:a + 4096]
            maps[a:a + 4096] = np.bitwise_and.reduce(bits[places(items.terms[some], level, width)], axis=1)
        if before is not None:
            maps &= before
        any_ = maps.any(axis=1)
        alive, before = alive[any_], maps[any_]
        if not len(alive):
            break
        row = np.full(len(items.terms), -1)
        row[alive] = np.arange(len(alive))
        held.append((before, row))
    # a term found at a level but not at the next occurs at most as often as the next level's least, less one
    most = [np.minimum(n, LEVELS[i + 1] - 1) if i + 1 < len(LEVELS) else n for i in range(len(held))]
    step = np.diff(np.stack([np.zeros(docs, np.int64), *(saturation(np.maximum(t, 1), m) for t in most)]), axis=0) if held else []
    for q, (at, weight) in enumerate(items.own):
        total = None
        for (maps, row), more in zip(held, step):
            mine = row[at]
            some = mine >= 0
            if not some.any():
                break
            there = np.unpackbits(maps[mine[some]], axis=1, count=docs)
            part = (weight[some].astype(np.float64) @ there).astype(np.int64) * more
            total = part if total is None else total + part
        if total is not None:
            yield q, total


def _highest(shared, rows: int, terms: int, keep: int):
    """The documents of a task with the highest bounds of each item."""

    def run(batches):
        items = shared.value
        best: list[list[tuple[int, int, int]]] = [[] for _ in items.own]
        for batch in batches:
            for b in range(batch.num_rows):
                width, n = batch.column("width")[b].as_py(), batch.column("n")[b].values.to_numpy()
                k, th = (batch.column(c)[b].values.to_numpy() for c in ("k", "th"))
                bits = np.frombuffer(batch.column("bits")[b].as_buffer(), np.uint8)
                for q, bound in bounds(items, width, n, bits, rows, terms):
                    least = best[q][-1][0] if len(best[q]) == keep else 0
                    some = np.flatnonzero(bound > least)
                    if len(some) > keep:
                        some = some[np.argpartition(-bound[some], keep - 1)[:keep]]
                    if len(some):
                        new = zip(bound[some].tolist(), k[some].tolist(), th[some].tolist())
                        best[q] = sorted([*best[q], *new], key=lambda x: (-x[0], x[1], x[2]))[:keep]
        for q, got in enumerate(best):
            if got:
                bound, k, th = zip(*got)
                yield pa.RecordBatch.from_pydict({
                    "q": np.full(len(got), q), "k": pa.array(k, pa.int64()), "th": pa.array(th, pa.int64()), "bound": pa.array(bound, pa.int64())})

    return run


def _reaching(shared, rows: int, terms: int, least: np.ndarray):
    """Every document whose bound reaches the item's threshold."""

    def run(batches):
        items = shared.value
        for batch in batches:
            for b in range(batch.num_rows):
                width, n = batch.column("width")[b].as_py(), batch.column("n")[b].values.to_numpy()
                k, th = (batch.column(c)[b].values.to_numpy() for c in ("k", "th"))
                bits = np.frombuffer(batch.column("bits")[b].as_buffer(), np.uint8)
                found = [(q, s) for q, bound in bounds(items, width, n, bits, rows, terms) if len(s := np.flatnonzero(bound >= least[q]))]
                if found:
                    at = np.concatenate([s for _, s in found])
                    yield pa.RecordBatch.from_pydict({
                        "q": np.repeat([q for q, _ in found], [len(s) for _, s in found]), "k": pa.array(k[at]), "th": pa.array(th[at])})

    return run


def _exact(shared, rows: int, terms: int):
    """Scores of texts for the items that ask for them."""

    def run(batches):
        items = shared.value
        for batch in batches:
            for i, strings in arrays.slices(batch.column("text")):
                asked = batch.column("qs").slice(i, len(strings)).to_pylist()
                got, owner, times, n = term_counts(strings)
                m = length_norm(n, rows, terms)
                edge = np.searchsorted(owner, np.arange(len(n) + 1))
                out = []
                for d, qs in enumerate(asked):
                    mine, tf = got[edge[d]:edge[d + 1]], times[edge[d]:edge[d + 1]]
                    if not len(mine):
                        continue
                    gain = saturation(tf, m[d])
                    at = np.minimum(np.searchsorted(mine, items.terms), len(mine) - 1)
                    per = np.where(mine[at] == items.terms, gain[at], 0)
                    out += [(q, int((items.own[q][1] * per[items.own[q][0]]).sum())) for q in qs]
                th = np.repeat(batch.column("th").slice(i, len(strings)).to_numpy(), [len(q) if n[d] else 0 for d, q in enumerate(asked)])
                q, score = zip(*out) if out else ((), ())
                yield pa.RecordBatch.from_pydict({"q": pa.array(q, pa.int64()), "th": pa.array(th, pa.int64()), "score": pa.array(score, pa.int64())})

    return run


def _scored(index: Index, found: DataFrame, shared) -> DataFrame:
    """q, k, th, score of the candidates ``found`` (q, k, th): each text is fetched and scored once for all its items."""
    wanted = found.groupBy("q", "th").agg(F.min("k").alias("k"))
    wanted = wanted.groupBy("th").agg(F.min("k").alias("k"), F.collect_set("q").alias("qs"))
    if (wanted.agg(F.sum(F.size("qs"))).first()[0] or 0) <= SEND:
        wanted = F.broadcast(wanted)  # at most SEND pairs
    texts = _keyed(index.docs).join(wanted, ["k", "th"])
    score = texts.mapInArrow(_exact(shared, index.rows, index.terms), "q bigint, th bigint, score bigint").dropDuplicates(["q", "th"])
    return found.join(score, ["q", "th"])


def search(index: Index, items: DataFrame, results: int = RESULTS, first: int = FIRST) -> tuple[DataFrame, list[str]]:
    """(item_id, rank, k, score) of the ``results`` best documents of each item, and the folders of this result.

    ``k`` is the doc_id, or the least long for a null one. Equal scores rank by k. Rows of one (item_id, text) are
    one item; rows that share an id but not the text are items of their own; null texts and items of unknown
    terms alone have no results, and so has an empty table.
    """
    spark = items.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    kind = dict(items.dtypes)["item_id"]
    rows = items.select("item_id", F.xxhash64(text).alias("ih"), text.alias("text")).dropDuplicates(["item_id", "ih"])
    spare, kept = [shared_dir(spark, "items")], []
    wanted = staged(rows.mapInArrow(_item_terms, f"item_id {kind}, ih bigint, term bigint, times bigint")
                    .join(index.frequencies, "term"), "items", spare[0])
    groups = -(-wanted.count() // BLOCK_TERMS)
    wanted = wanted.withColumn("g", F.pmod(F.xxhash64("item_id", "ih"), F.lit(max(groups, 1))))

    def stage(df, purpose, folders=spare):
        folders.append(shared_dir(spark, purpose))
        return staged(df, purpose, folders[-1])

    out = spark.createDataFrame([], f"item_id {kind}, rank int, k bigint, score bigint")
    try:
        for g in range(groups):  # one block unless the items hold more than BLOCK_TERMS terms
            block = Items(wanted.where(F.col("g") == g).drop("g").collect(), index.rows)
            out = out.unionByName(stage(_best(index, block, results, first, kind, stage), "ranked", kept))
    finally:
        for f in spare:
            drop_dir(spark, f)
    return out, kept


def _best(index: Index, block: Items, results: int, first: int, kind: str, stage) -> DataFrame:
    """The results of one block of items."""
    spark = index.docs.sparkSession
    shared = spark.sparkContext.broadcast(block)
    n, total = index.rows, index.terms
    top = index.blocks.mapInArrow(_highest(shared, n, total, first), "q bigint, k bigint, th bigint, bound bigint")
    order = Window.partitionBy("q").orderBy(F.desc("bound"), "k", "th")
    top = stage(top.withColumn("i", F.row_number().over(order)).where(F.col("i") <= first).select("q", "k", "th"), "highest")
    place = Window.partitionBy("q").orderBy(F.desc("score"))
    tenth = _scored(index, top, shared).withColumn("i", F.row_number().over(place)).where((F.col("i") == results) & (F.col("score") > 0))
    least = np.ones(len(block), np.int64)
    for r in tenth.select("q", "score").collect():  # a number for each item of the block
        least[r.q] = r.score
    found = index.blocks.mapInArrow(_reaching(shared, n, total, least), "q bigint, k bigint, th bigint")
    copy = Window.partitionBy("q", "th").orderBy("k")  # of equal texts only the first ``results`` can be results
    found = stage(found.withColumn("i", F.row_number().over(copy)).where(F.col("i") <= results).drop("i"), "reaching")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "k")
    ranked = _scored(index, found, shared).where("score > 0").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= results)
    names = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(block.item)], f"q bigint, item_id {kind}")
    return ranked.join(F.broadcast(names), "q").select("item_id", F.col("rank").cast("int").alias("rank"), "k", "score")  # the block's items


ORACLE_11 = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT r, doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
dl AS (SELECT r, sum(tf)::BIGINT AS n FROM tf GROUP BY r),
s AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS l FROM dl),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (
  SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
w AS (SELECT item_id, term, times, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM q JOIN df USING (term), s),
m AS (SELECT r, 25 + (75 * n * n_docs) // l AS m FROM dl, s),
scored AS (
  SELECT item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM w JOIN tf USING (term) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10"""


@query("op11_ranked_search", ORACLE_11)
def op11_ranked_search(spark, folder):
    """The ten best documents of every benchmark item; odd rows and empty tables as in ``build`` and ``search``."""
    index = build(documents(spark, folder))
    try:
        out, _ = search(index, spark.read.parquet(f"{folder}/benchmark.parquet"))
    finally:
        index.close()
    return out.select("item_id", "rank", F.when(F.col("k") != LEAST_LONG, F.col("k")).alias("doc_id"), "score")
