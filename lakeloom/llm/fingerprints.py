"""Document fingerprints: threshold-scaled sketches of word shingles (built-in functions only).

A sketch keeps every distinct shingle hash below a fixed share of the hash space, so sketches of any
two texts can be merged by union and compared by intersection whatever their lengths. Texts of few
shingles keep all of them (share 1); a pair is compared at the smaller of its two shares, which is
the usual down-sampling of such sketches, so a short text never has an empty sketch. What part of a short
text is inside a long one is counted on all hashes of both where the long text is at hand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.base import documents, let, order_key, query, texts, words
from lakeloom.llm.order import bounds_of, slice_of

SHINGLE = 5          # words
SHARE_BITS = 3       # long texts keep the hashes below 2**-3 of the hash space
KEEP_ALL = 256       # texts of at most so many distinct shingles keep all


def shingle_hashes(text: Column, width: int = SHINGLE) -> Column:
    """Distinct hashes of all runs of ``width`` words; a shorter text is one shingle, no word none."""
    def runs(w):
        starts = F.sequence(F.lit(0), F.greatest(F.size(w) - width, F.lit(0)))
        # get() and not slice(): slice copies the whole array for every run; a missing word is null and not hashed
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(width)]))

    return let(words(text), lambda w: F.when(F.size(w) > 0, F.array_distinct(runs(w)))
               .otherwise(F.array().cast("array<bigint>")))


def below(hashes: Column, bits: int = SHARE_BITS) -> Column:
    """Hashes in the lowest 2**-bits of the non-negative-first hash space."""
    return F.filter(hashes, lambda x: (x >= 0) & (x < (1 << (64 - bits))))


def with_sketch(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds ``<name>`` (sorted hashes) and ``<name>_full`` (all shingles kept)."""
    raw = f"{name}_raw"
    df = df.withColumn(raw, shingle_hashes(F.col(text)))
    full = F.size(raw) <= KEEP_ALL
    return df.withColumn(f"{name}_full", full).withColumn(
        name, F.array_sort(F.when(full, F.col(raw)).otherwise(below(F.col(raw))))).drop(raw)


def fingerprint(name: str) -> Column:
    """Sketch as text: F (all shingles) or S (scaled), then 16 hex digits a hash."""
    digits = F.transform(F.col(name), lambda x: F.lpad(F.hex(x), 16, "0"))
    return F.concat(F.when(F.col(f"{name}_full"), "F").otherwise("S"), F.array_join(digits, ""))


def overlap(df: DataFrame, a: str, b: str, name: str, b_text: str | None = None) -> DataFrame:
    """Adds ``near_<name>`` (shared part of the union) and ``inside_<name>`` (part of ``a`` found in ``b``).

    Two texts without words are alike (1); a text without words is inside any other. With ``b_text``, the
    column of the text of ``b``, ``inside_<name>`` is exact where ``a`` keeps all its hashes; else it is
    null where none of these is low enough to be looked for in a scaled ``b``.
    """
    both = F.col(f"{a}_full") & F.col(f"{b}_full")
    x, y = (f"{name}_x", f"{name}_y")
    df = df.withColumn(x, F.when(F.col(f"{a}_full") & ~both, below(F.col(a))).otherwise(F.col(a))) \
           .withColumn(y, F.when(F.col(f"{b}_full") & ~both, below(F.col(b))).otherwise(F.col(b)))
    df = df.withColumn(f"{name}_i", F.size(F.array_intersect(x, y)))
    shared, union = F.col(f"{name}_i"), F.size(x) + F.size(y) - F.col(f"{name}_i")
    inside = F.when(F.col(f"{a}_full") & (F.size(a) == 0), 1.0)
    if b_text is not None:
        inside = inside.when(F.col(f"{a}_full") & ~both,
                             F.size(F.array_intersect(F.col(a), shingle_hashes(F.col(b_text)))) / F.size(a))
    inside = inside.when(F.size(x) > 0, shared / F.size(x))
    return df.withColumn(f"near_{name}", F.when(union > 0, shared / union).when(both, 1.0)) \
             .withColumn(f"inside_{name}", inside).drop(x, y, f"{name}_i")


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, its sketch, and text and sketch of the next document in ascending doc_id (last: the first).

    The order is cut into slices of bounded row count by approximate percentiles of the id, so one
    exchange of the rows by slice is enough and no task sees more than a slice; the first text of
    every slice is the neighbour of the last one of the slice before. Rows that share an id follow
    each other by text; a null id comes first.
    """
    keyed = texts(docs).withColumn("k", order_key())
    keyed = keyed.withColumn("slice", slice_of(bounds_of(docs)))  # at most MOST_SLICES values
    heads = keyed.groupBy("slice").agg(F.min("k").alias("k"))
    first = keyed.select("slice", "k", "text").join(F.broadcast(heads.withColumnRenamed("k", "h")), "slice") \
        .where(F.col("k") == F.col("h")).groupBy("slice").agg(F.min("text").alias("head"))
    order = Window.orderBy("slice")  # a row for each slice
    ring = first.select("slice", F.coalesce(F.lead("head").over(order), F.first("head").over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("head"))
    ring = with_sketch(ring, "head", "hs")
    own = with_sketch(keyed.repartition("slice"), "text", "s")  # texts are exchanged, sketches are not
    w = Window.partitionBy("slice").orderBy("k", "text")
    out = own.withColumn("next", F.lead(F.struct("text", "s", "s_full")).over(w)).join(ring, "slice")
    return out.select(
        "doc_id", "text", "s", "s_full",
        F.coalesce(F.col("next.text"), F.col("head")).alias("next_text"),
        F.coalesce(F.col("next.s"), F.col("hs")).alias("n"),
        F.coalesce(F.col("next.s_full"), F.col("hs_full")).alias("n_full"))


@query("op1_fingerprints")
def op1_fingerprints(spark, folder):
    """Sketches of every text and of its edited form, and their likeness."""
    df = with_next(documents(spark, folder))
    df = df.withColumn("n_chars", F.char_length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    df = df.withColumn("edited", F.concat(
        F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - cut),
        F.substring(F.col("next_text"), F.lit(1), cut)))
    df = with_sketch(df.drop("text"), "edited", "e")
    df = overlap(overlap(df, "s", "e", "edited", "edited"), "s", "n", "next", "next_text")
    return df.select("doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"),
                     fingerprint("s").alias("fingerprint"), fingerprint("e").alias("edited_fingerprint"),
                     "near_edited", "near_next", "inside_edited", "inside_next")
