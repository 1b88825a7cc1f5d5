"""Text columns: tokens, lines, fixed windows, previews."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CJK = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}ー]"
WORD_BREAK = r"[^\p{L}\p{N}]+"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def tokens(col: str | Column) -> Column:
    """Lower-case words of the whole text; runs of Han and kana, which have no blanks, as pairs of characters."""
    text = F.lower(_c(col))
    plain = F.filter(F.split(text, WORD_BREAK), lambda t: t != "")

    def pairs(run):
        return F.when(run.rlike(CJK) & (F.length(run) > 1), F.transform(
            F.sequence(F.lit(1), F.length(run) - 1), lambda i: F.substring(run, i, F.lit(2)))).otherwise(F.array(run))

    def cut(word):
        runs = F.regexp_extract_all(word, F.lit(f"{CJK}+|{CJK.replace('[', '[^', 1)}+"), F.lit(0))
        return F.when(word.rlike(CJK), F.flatten(F.transform(runs, pairs))).otherwise(F.array(word))

    # a Han or kana character has three bytes or more, so a text of one byte each needs no look
    cjk = (F.octet_length(text) > F.char_length(text) + 1) & text.rlike(CJK)
    return F.when(cjk, F.flatten(F.transform(plain, cut))).otherwise(plain)


def lines(col: str | Column) -> Column:
    return F.split(_c(col), "\n")


def nonblank_line_count(col: str | Column) -> Column:
    """Lines that hold more than white space."""
    return F.size(F.filter(lines(col), lambda x: F.regexp_replace(x, r"\s+", "") != "")).cast("long")


def fixed_windows(col: str | Column, size: int, overlap: int) -> Column:
    """Array of (pos, chunk_text): windows of ``size`` characters that share ``overlap`` characters."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than size")
    c = _c(col)
    step = size - overlap
    last = F.greatest(F.ceil((F.length(c) - overlap) / F.lit(step)) - 1, F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last),
                       lambda i: F.struct(i.alias("pos"), F.substring(c, i * step + 1, F.lit(size)).alias("chunk_text")))


def strip_tags(html: str | Column) -> Column:
    """Visible text of an HTML page: scripts, styles, comments and tags removed, blanks folded."""
    c = F.regexp_replace(_c(html), r"(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->", " ")
    c = F.regexp_replace(c, r"(?s)<[^>]*>", " ")
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        c = F.replace(c, F.lit(name), F.lit(char))
    return F.trim(F.regexp_replace(c, r"[ \t\r\n]+", " "))
