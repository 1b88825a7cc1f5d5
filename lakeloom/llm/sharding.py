"""Sharding by histogram sort (built-in functions only).

Rows are ordered by (hash of the text, doc_id, place in the files). Exact byte histograms below candidate
keys are counted across all partitions; only the bins that hold an unmet splitter are probed again, more
finely, until every splitter is within tolerance or lies between two single rows. Then the rows are
exchanged once. Equal texts are neighbours, so a group is cut only where it is larger than a shard
leaves room for; the place tells repeated rows apart, however many there are.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeloom.llm.base import LEAST_LONG, documents, order_key, query, staged

SHARDS = 40
KEY = ("h", "k", "u")
TOLERANCE = 0.002          # of an even part
PART_BYTES = 256 << 20     # a shard larger than this is sorted in several parts
MOST_PARTS = 10_000        # splitters the driver may hold
HEAD_SHIFT = 52            # the first histogram has 2**12 bins
PROBE_BITS = 6             # later ones split a bin into at most 2**6


def placed(docs: DataFrame) -> DataFrame:
    """Struct ``row`` and ``u``, a hash of the row's file and its number there: the same in every scan of the table.

    A table that does not come straight from files is written to the shared folder first.
    """
    def from_files(df):
        at = df.metadataColumn("_metadata")
        return df.select(F.struct(*df.columns).alias("row"), F.xxhash64(at["file_path"], at["row_index"]).alias("u"))

    try:
        return from_files(docs)
    except AnalysisException:
        return from_files(staged(docs, "shard-rows"))


def keyed(rows: DataFrame) -> DataFrame:
    """Adds the sort key (h, k, u) and the size of ``row``."""
    text = F.coalesce(F.col("row.text"), F.lit(""))
    return rows.select("row", F.xxhash64(text).alias("h"), order_key("row.doc_id").alias("k"), "u",
                       (F.octet_length(text) + 16).cast("long").alias("size"))


def _bins(df: DataFrame, *by: str) -> list:
    ends = [f(c).alias(f"{c}{i}") for c in KEY for i, f in enumerate((F.min, F.max))]
    return df.groupBy(*by).agg(F.sum("size").alias("bytes"), *ends).collect()


def _level(lo: tuple, hi: tuple) -> int:
    """First part of the key in which the ends of a bin differ; 3 for a single key."""
    return next((i for i in range(3) if lo[i] != hi[i]), 3)


def _shift(lo: int, hi: int) -> int:
    return max(0, ((lo ^ hi) & ((1 << 64) - 1)).bit_length() - PROBE_BITS)


def _least(key: tuple, level: int) -> tuple:
    """The least key that agrees with ``key`` up to part ``level``."""
    return tuple(v if i <= level else LEAST_LONG for i, v in enumerate(key))


def splitters(slim: DataFrame, parts: int, tolerance: float = TOLERANCE) -> list[tuple[int, int, int]]:
    """At most ``parts - 1`` keys (h, k, u): the first row of each part but the first."""
    spark = slim.sparkSession
    slim = slim.withColumn("p0", F.shiftright("h", HEAD_SHIFT))
    found, open_bins = {}, {}

    def settle(bins, start, targets):
        """Meet targets inside neighbouring bins whose first byte is ``start``; keep the rest open."""
        below, i = start, 0
        for size, lo, hi in sorted(((b["bytes"], *[tuple(b[f"{c}{e}"] for c in KEY) for e in "01"]) for b in bins),
                                   key=lambda b: b[1]):
            above, level = below + size, _level(lo, hi)
            while i < len(targets) and targets[i] < above:
                t = targets[i]
                if level == 3 or min(t - below, above - t) <= slack:
                    if t - below <= above - t:
                        found[t] = _least(lo, level)
                    else:  # the part begins behind this bin
                        last = min(level, 2)
                        found[t] = _least((*hi[:last], hi[last] + 1, *hi[last + 1:]), last)
                else:
                    open_bins.setdefault((lo, hi), [below, []])[1].append(t)
                i += 1
            below = above

    head = _bins(slim, "p0")
    total = sum(b["bytes"] for b in head)
    if not total or parts < 2:
        return []
    slack = tolerance * total / parts
    settle(head, 0, [total * j / parts for j in range(1, parts)])
    while open_bins:
        todo, open_bins = list(open_bins.items()), {}
        rows = []
        for i, ((lo, hi), _) in enumerate(todo):
            level = _level(lo, hi)
            rows.append((i, lo[0] >> HEAD_SHIFT, level, lo[0], lo[1], lo[level], hi[level], _shift(lo[level], hi[level])))
        probes = spark.createDataFrame(
            rows, "i int, p0 bigint, level int, at_h bigint, at_k bigint, lo bigint, hi bigint, s int")
        hit = slim.join(F.broadcast(probes), "p0").withColumn("v", F.expr("CASE level WHEN 0 THEN h WHEN 1 THEN k ELSE u END"))
        hit = hit.where("v BETWEEN lo AND hi AND (level = 0 OR h = at_h) AND (level < 2 OR k = at_k)")  # fewer probes than parts
        by_bin = {}
        for b in _bins(hit.withColumn("bin", F.expr("shiftright(v, s)")), "i", "bin"):
            by_bin.setdefault(b["i"], []).append(b)
        for i, (_, (start, targets)) in enumerate(todo):
            settle(by_bin[i], start, targets)
    return [found[t] for t in sorted(found)]


def _with_part(df: DataFrame, cuts: list[tuple[int, int, int]]) -> DataFrame:
    """Adds ``part``: how many splitters are at or below the row's key (h, k, u)."""
    cuts = sorted(cuts)
    heads = [c[0] >> HEAD_SHIFT for c in cuts]
    table = []
    for p in range(-(1 << 63 - HEAD_SHIFT), 1 << 63 - HEAD_SHIFT):
        a, b = bisect_right(heads, p - 1), bisect_right(heads, p)
        table.append((p, a, cuts[a:b]))
    look = df.sparkSession.createDataFrame(table, "p0 bigint, base int, cuts array<struct<h: bigint, k: bigint, u: bigint>>")
    df = df.withColumn("p0", F.shiftright("h", HEAD_SHIFT)).join(F.broadcast(look), "p0")  # 2**12 rows
    at = F.filter("cuts", lambda c: c <= F.struct(*KEY))
    return df.withColumn("part", F.col("base") + F.size(at)).drop("p0", "base", "cuts")


def shard(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE,
          part_bytes: int = PART_BYTES) -> DataFrame:
    """All rows and columns of ``docs`` as struct ``row``, with size, shard and slot.

    A null text counts as empty; a null id sorts first. Repeated rows are rows of their own and may be
    cut between two shards. An empty table gives no rows. The documents' own columns travel inside
    ``row``, so names cannot clash.
    """
    rows = keyed(placed(docs))
    slim = staged(rows.drop("row"), "shard-sizes")
    total = slim.agg(F.sum("size")).first()[0] or 0
    per = max(1, min(MOST_PARTS // shards, -(-total // (part_bytes * shards))))
    cuts = splitters(slim, shards * per, tolerance)
    counts = _with_part(slim, cuts).groupBy("part").agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("shard", F.expr(f"int(part div {per})"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*KEY))
    return _with_part(rows, cuts).withColumn("place", place).join(F.broadcast(offsets), "part").select(  # MOST_PARTS rows
        "row", "size", "shard", (F.col("before") + F.col("place") - 1).alias("slot"))


@query("op2_sharding")
def op2_sharding(spark, folder):
    """Every document in one of 40 shards of near equal bytes."""
    return shard(documents(spark, folder)).select(
        F.col("row.doc_id").alias("doc_id"), "size",
        F.crc32(F.coalesce(F.col("row.text"), F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
