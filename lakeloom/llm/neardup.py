"""Near-duplicate classes by BagMinHash: weighted-Jaccard signatures of word shingles, bands, exact check.

A text is the multiset of its runs of SHINGLE words. Each (shingle, weight interval) is a Poisson
process of points (time, weight, slot) drawn from hashes; the intervals [0,1), [1,2), [2,4), ... split
the weights, and a point counts for a text if its weight lies below the shingle's multiplicity. The
first point of a slot is the signature there, so two texts agree in a slot with exactly their weighted
Jaccard similarity. Points are made in order of time and only up to the time by which all slots of the
text are filled: about one draw a shingle, not one for each slot.

Texts that agree in a band are compared exactly, unless links have made them one class before. In each bucket the
member that meets most others in all its buckets, its hub, is compared with the rest first. Then the members of each
bucket that still holds several classes meet in a task, in a grid of cells where there are many: two in different classes
whose signatures agree in AGREE slots or more (of pairs of similarity 0.8 all but one in 100 million do) are compared, and
a link makes their classes one for the rest of the cell. So pairs are never rows, and a cell gives a link for each class
that another takes in. What is lost are pairs that share no band: of similarity 0.8 one in 80.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm import arrays
from lakeloom.llm.base import documents, order_key, query, staged
from lakeloom.session import drop_dir, shared_dir

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 8
SLOTS = BANDS * ROWS
AGREE = 120  # slots in which two signatures agree at least if the texts are compared
BLOCK = 2048  # members of a bucket on either side of a cell, or
BLOCK_SHINGLES = 1 << 18  # their shingles, if these are more
SLACK = 6.0  # a slot of a text is still empty at the first horizon with probability e**-SLACK at most

U = np.uint64
_GOLD = U(0x9E3779B97F4A7C15)
_ALL = (1 << 64) - 1


def shingles(words: arrays.Runs, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every shingle; a text of fewer words is one shingle, of none none."""
    h, first = words.hashes(), words.first
    starts = arrays.window_starts(first, width)
    text = words.text_of()
    keys, owner = arrays.window_hashes(h, starts, width), text[starts]
    n = words.per_text()
    short = np.flatnonzero((n > 0) & (n < width))
    for size in range(1, width):
        some = short[n[short] == size]
        keys = np.append(keys, arrays.window_hashes(h, first[some], size))
        owner = np.append(owner, some)
    return keys, owner


def multisets(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (hash, text) with multiplicity."""
    _, at, times = np.unique(arrays.salted(keys, owner), return_index=True, return_counts=True)
    return keys[at], owner[at], times


def signatures(keys: np.ndarray, owner: np.ndarray, times: np.ndarray, texts: int, slots: int = SLOTS) -> np.ndarray:
    """texts x slots point numbers; rows of texts without shingles are 0."""
    weight = np.bincount(owner, weights=times, minlength=texts)
    ids = np.zeros((texts, slots), np.uint64)
    horizon = np.where(weight > 0, slots * (math.log(slots) + SLACK) / np.maximum(weight, 1), 0.0)
    todo = weight > 0
    while todo.any():
        mine = todo[owner]
        time, number = _first_points(keys[mine], owner[mine], times[mine], horizon, texts, slots)
        full = todo & np.isfinite(time).all(axis=1)
        ids[full] = number[full]
        todo &= ~full
        horizon[todo] *= 2
    return ids


def _first_points(keys, owner, times, horizon, texts, slots):
    """Time and number of the first point of every slot up to each text's horizon."""
    levels = np.where(times > 1, np.ceil(np.log2(np.maximum(times, 1))).astype(np.int64) + 1, 1)
    at = np.repeat(np.arange(len(keys)), levels)
    level = np.arange(len(at)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level > 0, 2.0 ** (level - 1), 0.0)
    size = np.maximum(low, 1.0)
    seed = arrays.mix(keys[at] + _GOLD * (level.astype(np.uint64) + U(1)))
    owner, most = owner[at], times[at].astype(np.float64)
    clock, end = np.zeros(len(at)), horizon[owner]
    time = np.full(texts * slots, np.inf)
    seen, k = [], 0
    while len(seed):
        k += 1
        draw = arrays.mix(seed + U(int(_GOLD) * k & _ALL))
        clock = clock - np.log(((draw >> U(11)).astype(np.float64) + 1.0) * 2.0 ** -53) / size
        alive = clock <= end
        seed, owner, low, size, most, clock, end, draw = (
            x[alive] for x in (seed, owner, low, size, most, clock, end, draw))
        point = arrays.mix(draw ^ _GOLD)
        height = low + size * ((point & U(0xFFFFFFFF)).astype(np.float64) * 2.0 ** -32)
        hit = height < most
        slot = owner[hit] * slots + (((point[hit] >> U(32)) * U(slots)) >> U(32)).astype(np.int64)
        np.minimum.at(time, slot, clock[hit])
        seen.append((slot, clock[hit], point[hit]))
    number = np.zeros(texts * slots, np.uint64)
    for slot, clock, point in seen:
        won = time[slot] == clock
        number[slot[won]] = point[won]
    return time.reshape(texts, slots), number.reshape(texts, slots)


def _content(words: arrays.Runs) -> np.ndarray:
    """Number of the word sequence of each text: equal for texts of equal words in equal order."""
    h, first, n = words.hashes(), words.first, words.per_text()
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * arrays.powers(arrays._WINDOW, len(h)), out=total[1:], dtype=np.uint64)
    back = np.append(arrays.powers(arrays._WINDOW_INV, len(h)), U(0))
    return arrays.mix((total[first[1:]] - total[first[:-1]]) * back[np.minimum(first[:-1], len(h))] + n.astype(np.uint64) * _GOLD)


def _sign(batches):
    for batch in batches:
        for i, strings in arrays.slices(batch.column("text")):
            n = len(strings)
            _, words = arrays.words_of(strings)
            keys, owner = shingles(words)
            ids = signatures(*multisets(keys, owner), n)
            size = np.bincount(owner, minlength=n)
            band = np.zeros((n, BANDS), np.uint64)
            for b in range(BANDS):
                h = np.full(n, U(int(_GOLD) * (b + 1) & _ALL))
                for r in range(ROWS):
                    h = arrays.mix(h + ids[:, b * ROWS + r])
                band[:, b] = h
            bands = [x.view(np.int64) if s else np.zeros(0, np.int64) for x, s in zip(band, size)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id").slice(i, n), "k": batch.column("k").slice(i, n),
                "th": batch.column("th").slice(i, n), "node": _content(words).view(np.int64),
                "n": size, "bands": pa.array(bands, pa.list_(pa.int64())),
                "slots": pa.FixedSizeBinaryArray.from_buffers(pa.binary(SLOTS), n, [None, pa.py_buffer(ids.astype(np.uint8).tobytes())]).cast(pa.binary())})


def _cells(batches):
    """(rows, borders) of whole cells, about BLOCK_SHINGLES at a time; rows come in order of (b, lo, hi)."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = (table if rest is None else pa.concat_tables([rest, table])).combine_chunks()
        if rest.num_rows:
            begin = _begins(rest)
            yield from _some_cells(rest, begin)
            rest = rest.slice(begin[-1])
    if rest is not None and rest.num_rows:
        yield from _some_cells(rest, [0, rest.num_rows])


def _begins(rows: pa.Table) -> list[int]:
    keys = np.stack([rows.column(c).to_numpy() for c in ("b", "lo", "hi")])
    return [0, *(np.flatnonzero((np.diff(keys) != 0).any(axis=0)) + 1).tolist()]


def _some_cells(rows: pa.Table, begin: list[int]):
    upto = np.append(0, np.cumsum(rows.column("n").to_numpy()))
    i = 0
    while i < len(begin) - 1:
        j = i + 1
        while j < len(begin) - 1 and upto[begin[j + 1]] - upto[begin[i]] <= BLOCK_SHINGLES:
            j += 1
        yield rows.slice(begin[i], begin[j] - begin[i]), [x - begin[i] for x in begin[i:j + 1]]
        i = j


def _alike(inside, na, nb):
    """Whether multisets of ``na`` and ``nb`` shingles are alike that share ``inside``."""
    return 10 * inside >= 8 * (na + nb - inside) if SIMILARITY == 0.8 else inside >= SIMILARITY * (na + nb - inside)


def _meet(batches):
    """Links between the classes of each cell: all its members in different classes are compared until a link makes these one."""
    for rows, begin in _cells(batches):
        node, n, mine, lo, hi = (rows.column(c).to_numpy() for c in ("node", "n", "mine", "lo", "hi"))
        label = rows.column("label").to_numpy().copy()
        slots = np.frombuffer(b"".join(rows.column("slots").to_pylist()), np.uint8).reshape(-1, SLOTS)
        (_, strings), = arrays.slices(rows.column("text"), 1 << 62)
        keys, owner, times = multisets(*shingles(arrays.words_of(strings)[1]))
        order = np.argsort(owner, kind="stable")
        first, times = np.searchsorted(owner[order], np.arange(len(n) + 1)), times[order]
        kinds, ids = np.unique(keys[order], return_inverse=True)
        here, links = np.zeros(len(kinds), np.int64), []
        for i, j in zip(begin, begin[1:]):
            for x in range(i, j - 1):
                some = label[x + 1:j] != label[x]
                if lo[x] != hi[x]:
                    some &= mine[x + 1:j] != mine[x]
                some = np.flatnonzero(some) + x + 1
                some = some[10 * np.minimum(n[some], n[x]) >= 8 * np.maximum(n[some], n[x])]
                some = some[(slots[some] == slots[x]).sum(axis=1) >= AGREE]
                if not len(some):
                    continue
                own = slice(first[x], first[x + 1])
                here[ids[own]] = times[own]
                size = first[some + 1] - first[some]
                start = np.cumsum(size) - size
                flat = np.arange(int(size.sum())) + np.repeat(first[some] - start, size)
                inside = np.add.reduceat(np.minimum(times[flat], here[ids[flat]]), start)
                here[ids[own]] = 0
                for y in some[_alike(inside, n[some], n[x])].tolist():
                    if label[y] != label[x]:
                        links.append((node[x], node[y]))
                        label[i:j][label[i:j] == label[y]] = label[x]
        yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in links], pa.int64()) for k in (0, 1)], ["a", "b"])


def _compare(batches):
    """Pairs of texts whose multisets overlap enough."""
    for batch in batches:
        for i, a in arrays.slices(batch.column("text_a")):
            n = len(a)
            (_, b), = arrays.slices(batch.column("text_b").slice(i, n), 1 << 62)
            both = []
            for strings in (a, b):
                keys, owner = shingles(arrays.words_of(strings)[1])
                size = np.bincount(owner, minlength=n)
                keys, owner, times = multisets(keys, owner)
                order = np.argsort(arrays.salted(keys, owner))
                both.append((arrays.salted(keys, owner)[order], owner[order], times[order], size))
            (ka, owner, ta, na), (kb, _, tb, nb) = both
            _, x, y = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
            inside = np.bincount(owner[x], weights=np.minimum(ta[x], tb[y]), minlength=n)
            some = np.flatnonzero(_alike(inside, na, nb) & (inside > 0))
            yield pa.RecordBatch.from_pydict({c: batch.column(c).slice(i, n).take(pa.array(some)) for c in ("a", "b")})


class _Folders:
    """Staged tables of one run."""

    def __init__(self, spark):
        self.spark, self.paths = spark, []

    def stage(self, df: DataFrame, purpose: str) -> DataFrame:
        self.paths.append(shared_dir(self.spark, purpose))
        return staged(df, purpose, self.paths[-1])

    def close(self) -> None:
        for p in self.paths:
            drop_dir(self.spark, p)


def components(links: DataFrame, stage) -> DataFrame:
    """node, label (smallest node it is linked to over any number of links), by alternating large and small stars."""

    def state(df):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()

    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        edges = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        edges = edges.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")) \
            .select("e.u", "e.v").where("u > v").distinct()
        edges = stage(edges, "components")
        now = state(edges)
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        before = now


def _classes(docs: DataFrame, own: _Folders) -> tuple[DataFrame, DataFrame]:
    """(signed rows, node with its label, first row k and th)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", order_key().alias("k"), F.xxhash64(text).alias("th"), text.alias("text"))
    signed = own.stage(rows.mapInArrow(
        _sign, f"doc_id {dict(docs.dtypes)['doc_id']}, k bigint, th bigint, node bigint, n bigint, bands array<bigint>, slots binary"), "signed")
    nodes = signed.groupBy("node").agg(F.min(F.struct("k", "th")).alias("at"), F.max("n").alias("n"))
    nodes = own.stage(nodes.select("node", "at.k", "at.th", "n"), "nodes")
    bands = own.stage(signed.join(nodes.select("node", "k", "th"), ["node", "k", "th"]).dropDuplicates(["node"])
                      .where(F.size("bands") > 0).select("node", "n", "bands", "slots"), "bands")

    def texts_of(wanted):
        at = wanted.join(nodes, "node").select("node", "k", "th")
        return docs.select(order_key().alias("k"), F.xxhash64(text).alias("th"), text.alias("text")) \
            .join(at, ["k", "th"]).select("node", "text").dropDuplicates(["node"])

    def verify(pairs):
        both = pairs.join(found.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a") \
            .join(found.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        return own.stage(both.mapInArrow(_compare, "a bigint, b bigint"), "links")

    def merged(named, links):
        """Labels after new links: only labels that a link joins go through the components."""
        ends = links.join(named.select(F.col("node").alias("a"), F.col("label").alias("x")), "a") \
            .join(named.select(F.col("node").alias("b"), F.col("label").alias("y")), "b") \
            .where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b"))
        new = components(ends, own.stage).select(F.col("node").alias("label"), F.col("label").alias("to"))
        return own.stage(named.join(new, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels")

    named = nodes.select("node", F.col("node").alias("label"))
    members = bands.select("node", "n", F.explode("bands").alias("b"))
    members = own.stage(members.join(members.groupBy("b").agg(F.count("b").alias("m")).where("m > 1"), "b"), "members")
    found = own.stage(texts_of(members.select("node").distinct()), "texts")
    # the hub is the text met most: the one that others were copied from
    met = members.groupBy("node").agg((-F.sum("m")).alias("met"))
    ranked = members.join(met, "node").select("b", "node", "n", F.struct("met", "node").alias("r"))
    hubs = ranked.groupBy("b").agg(F.min(F.struct("r", "n")).alias("h")).select("b", F.col("h.r.node").alias("hub"), F.col("h.n").alias("hub_n"))
    pairs = members.join(hubs, "b").where("node <> hub and 10 * least(n, hub_n) >= 8 * greatest(n, hub_n)") \
        .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    pairs = own.stage(pairs, "pairs")
    if not pairs.isEmpty():
        named = merged(named, verify(pairs))
    labelled = members.select("b", "node", "n").join(named, "node")
    blocks = F.ceil(F.greatest(F.count("b") / BLOCK, F.sum("n") / BLOCK_SHINGLES))
    mixed = labelled.groupBy("b").agg(F.min("label").alias("x"), F.max("label").alias("y"), blocks.alias("blocks")).where("x <> y").select("b", "blocks")
    cells = labelled.join(mixed, "b").withColumn("mine", F.expr("pmod(xxhash64(node), blocks)")) \
        .join(bands.select("node", "slots"), "node").join(found, "node").withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)"))) \
        .select("b", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), "mine", "node", "n", "label", "slots", "text")
    links = own.stage(cells.repartition("b", "lo", "hi").sortWithinPartitions("b", "lo", "hi").mapInArrow(_meet, "a bigint, b bigint"), "links")
    if not links.isEmpty():
        named = merged(named, links)
    return signed, named.join(nodes, "node").select("node", "k", "th", "label")


def near_classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id of every row: the smallest doc_id of its class.

    Texts are alike from SIMILARITY of their shingle multisets on; equal word sequences are one class,
    empty and null texts are one. Rows that share an id each have the class of their text; a null id
    stands before all others and names its class by the least long. An empty table gives no rows.
    """
    own = _Folders(docs.sparkSession)
    try:
        signed, named = _classes(docs, own)
        first = named.groupBy("label").agg(F.min("k").alias("class_id"))
        names = named.join(first, "label").select("node", "class_id")
        return staged(signed.select("doc_id", "node").join(names, "node").select("doc_id", "class_id"), "near-classes")
    finally:
        own.close()


def class_heads(docs: DataFrame) -> DataFrame:
    """k (order of doc_id) and th (hash of the text) of the first row of every class."""
    own = _Folders(docs.sparkSession)
    try:
        _, named = _classes(docs, own)
        return staged(named.groupBy("label").agg(F.min(F.struct("k", "th")).alias("at")).select("at.k", "at.th"), "class-heads")
    finally:
        own.close()


def first_of_class(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that stand first in their class in order of (doc_id, hash of the text); one each.

    Repeated rows stand at the same place; of them one stays.
    """
    text = F.coalesce(F.col("row.text"), F.lit(""))
    rows = docs.select(F.struct("*").alias("row")).select("row", order_key("row.doc_id").alias("k"), F.xxhash64(text).alias("th"))
    keep = class_heads(docs)
    return rows.join(keep, ["k", "th"]).dropDuplicates(["k", "th"]).select("row.*")


@query("op3_near_duplicates")
def op3_near_duplicates(spark, folder):
    """Class of near-duplicate texts of every document."""
    return near_classes(documents(spark, folder))
