"""Set-similarity join by prefixes and lengths.

The words of a set are ordered by rarity. Two sets of similarity t or more (Jaccard) share a word among the
first |x| - ceil(t |x|) + 1 of each, their sizes differ by the factor t at most, and the words behind their
first shared one must be enough to reach t. So only rare words are join keys, and a common word is one only
for the few sets that have nothing rarer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.session import cut_lineage

STEPS = (0.3, 0.15)  # thresholds tried before the caller's: most best matches are found with short prefixes


def rarity(*sets: DataFrame) -> DataFrame:
    """term, df over all sets (frames with ``words``)."""
    every = None
    for s in sets:
        part = s.select(F.explode("words").alias("term"))
        every = part if every is None else every.unionByName(part)
    return every.groupBy("term").agg(F.count("term").alias("df"))


def ordered(sets: DataFrame, key: list[str], df: DataFrame) -> DataFrame:
    """key, words from the rarest to the commonest; sets without words stay."""
    long = sets.select(*key, F.explode("words").alias("term")).join(df, "term")
    got = long.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("df", "term"))).alias("w"))
    return got.select(*key, F.transform("w", lambda x: x.term).alias("words"))


def prefix_size(n: Column, t: float) -> Column:
    return n - F.ceil(F.lit(t) * n - F.lit(1e-9)).cast("int") + 1


def candidates(left: DataFrame, left_key: list[str], right: DataFrame, right_key: list[str], t: float) -> DataFrame:
    """Distinct pairs that can have similarity ``t``; t = 0: all that share a word."""
    def prefix(df, key, name):
        n = F.size("words")
        kept = F.slice("words", 1, F.greatest(prefix_size(n, t), F.lit(1))) if t else F.col("words")
        return df.where(n > 0).select(*key, n.alias(f"n_{name}"), F.posexplode(kept).alias(f"i_{name}", "term"))

    pairs = prefix(left, left_key, "l").join(prefix(right, right_key, "r"), "term")
    if t:
        small, large = F.least("n_l", "n_r"), F.greatest("n_l", "n_r")
        rest = 1 + F.least(F.col("n_l") - F.col("i_l"), F.col("n_r") - F.col("i_r")) - 1
        need = F.lit(t / (1 + t)) * (F.col("n_l") + F.col("n_r")) - 1e-9
        pairs = pairs.where((small >= t * large - 1e-9) & (rest >= need))
    return pairs.select(*left_key, *right_key).distinct()


def best_match(questions: DataFrame, question_key: list[str], text_words: Column, stored: DataFrame, stored_id: str,
               stored_words: Column, threshold: float) -> DataFrame:
    """question key, score, stored_id: the stored set of highest Jaccard (ties: lowest id) of each question.

    ``stored_id`` is null below the threshold, the score is 0 where no word is shared. Thresholds are tried from
    high to low, and a question leaves when its best match reaches the one that was tried, as none that was
    not compared can be better. Only questions without a match at ``threshold`` meet all sets with a common word.
    """
    q = questions.select(*question_key, F.array_distinct(text_words).alias("words"))
    s = stored.select(F.col(stored_id).cast("long").alias("stored_id"), F.array_distinct(stored_words).alias("words"))
    df = cut_lineage(rarity(q, s))
    q_all = q.select(*question_key)
    q, s = cut_lineage(ordered(q, question_key, df)), cut_lineage(ordered(s, ["stored_id"], df))
    open_, found = q, None
    for t in [*(x for x in STEPS if x > threshold), threshold, 0.0]:
        pairs = candidates(open_, question_key, s, ["stored_id"], max(0.0, t - 1e-6))  # scores are rounded to that
        both = pairs.join(open_.withColumnRenamed("words", "qw"), question_key).join(s.withColumnRenamed("words", "sw"), "stored_id")
        n = F.size(F.array_intersect("qw", "sw"))
        score = F.round(n / (F.size("qw") + F.size("sw") - n), 6)
        best = both.select(*question_key, F.struct(score.alias("score"), (-F.col("stored_id")).alias("neg")).alias("b")) \
            .groupBy(*question_key).agg(F.max("b").alias("b"))
        best = cut_lineage(best.where(F.col("b.score") >= t) if t else best)
        found = best if found is None else found.unionByName(best)
        if not t:
            break
        open_ = cut_lineage(open_.join(best, question_key, "left_anti"))
        if open_.isEmpty():
            break
    out = q_all.join(found, question_key, "left")
    score = F.coalesce("b.score", F.lit(0.0))
    return out.select(*question_key, score.alias("score"), F.when(score >= threshold, -F.col("b.neg")).alias("stored_id"))
