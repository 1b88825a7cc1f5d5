"""Chat formatting by a grammar round trip (built-in functions only).

Grammar of a formatted conversation::

    conversation := turn*
    turn         := "### " role ": " body "</turn>" newline

``###`` begins a turn and ``</turn>`` ends one, wherever they stand, and in a body a backslash makes the
character behind it plain. A turn is first rendered with its text as it is and read back by the parser. If
what comes back is not the role and text that went in, the text is escaped by one level more and the
turn is rendered anew, until both are identical:

* level 0: the text itself;
* level 1: a backslash inside every ``###`` and ``</turn>``, so neither mark occurs in the body;
* level 2: every backslash doubled as well.

Level 2 always comes back: the parser drops exactly the backslashes that were put in. A turn ends with a
newline, so no mark can begin in one turn and end in the next, and turns that come back one by one come
back from the whole conversation too; this is checked again on every formatted conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.base import let, query

MARK, END = "###", "</turn>"
LEVELS = (0, 1, 2)
LEARNT = "assistant"  # the role whose texts are under the loss mask
_ROLE = (("\\", "\\b"), (":", "\\c"), ("#", "\\h"), ("<", "\\l"))  # in a role: never a mark or the colon


def _role(role: Column, back: bool = False) -> Column:
    for plain, code in reversed(_ROLE) if back else _ROLE:
        role = F.replace(role, F.lit(code if back else plain), F.lit(plain if back else code))
    return role


def escaped(text: Column, level: int) -> Column:
    """The body of a text at one of LEVELS."""
    if level > 1:
        text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    if level:
        text = F.regexp_replace(F.regexp_replace(text, "#(?=##)", r"#\\"), "<(?=/turn>)", r"<\\")
    return text


def unescaped(body: Column) -> Column:
    return F.regexp_replace(body, r"(?s)\\(.)", "$1")


def rendered(role: Column, body: Column) -> Column:
    return F.concat(F.lit(MARK + " "), _role(role), F.lit(": "), body, F.lit(END + "\n"))


def segments(formatted: Column) -> Column:
    """The pieces that begin at a mark."""
    return F.split(formatted, f"(?={MARK})")


def _parsed(segment: Column) -> Column:
    """role, text, and the place of the body in the segment; null where the segment is no turn of the grammar."""
    def read(s):
        colon, end = F.locate(": ", s.s), F.locate(END, s.s)
        body = F.substring(s.s, colon + 2, end - colon - 2)
        turn = F.struct(_role(F.substring(s.s, F.lit(len(MARK) + 2), colon - len(MARK) - 2), back=True).alias("role"),
                        unescaped(body).alias("text"), (colon + 2).alias("start"), (end - colon - 2).alias("length"))
        whole = s.s.startswith(MARK + " ") & (colon > 0) & (end > colon) & (F.substring(s.s, end, F.char_length(s.s)) == END + "\n")
        return F.when(whole, turn)

    return let(F.struct(segment.alias("s")), read)


def parsed(formatted: Column) -> Column:
    """Turns of a formatted conversation: array of (role, text, start, length of the body in its segment)."""
    return F.transform(segments(formatted), _parsed)


def _comes_back(role: Column, text: Column, turn: Column) -> Column:
    """Whether the parser makes exactly this one turn of the rendered one."""
    return let(parsed(turn), lambda got: (F.size(got) == 1) & F.coalesce((got[0].role == role) & (got[0].text == text), F.lit(False)))


def render_turns(turns: DataFrame) -> DataFrame:
    """``role`` and ``text`` without nulls, ``level`` (escapes needed) and ``rendered`` for each row; other columns stay."""
    rows = turns.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text")})
    role, text = F.col("role"), F.col("text")
    level = F.lit(LEVELS[-1])
    for n in reversed(LEVELS[:-1]):  # the first level that comes back
        level = F.when(_comes_back(role, text, rendered(role, escaped(text, n))), F.lit(n)).otherwise(level)
    rows = rows.withColumn("level", level)
    body = escaped(text, LEVELS[-1])
    for n in reversed(LEVELS[:-1]):
        body = F.when(F.col("level") == n, escaped(text, n)).otherwise(body)
    return rows.withColumn("rendered", rendered(role, body))


def _digest(role: Column, text: Column) -> Column:
    return F.sha2(F.concat(role, F.lit("\n"), text), 256)


def format_chat(conversations: DataFrame, learnt: str = LEARNT) -> DataFrame:
    """conv_id, formatted, n_escaped (turns above level 0), loss: array of (turn from 0, start, length).

    A loss entry is one text of the role ``learnt``: code points of its body within the piece of that turn
    (``segments``), still escaped. Turns follow each other by (turn, role, digest); null turn numbers come
    last, null roles and texts are empty, repeated rows are turns of their own, rows of a null conv_id are one
    conversation, an empty table gives no rows. Other columns are not read. A formatted conversation is one cell and so
    is built in one task; all parsing and escaping of single turns is done before the rows meet.
    """
    turns = render_turns(conversations.select("conv_id", "turn", "role", "text"))
    rows = turns.select("conv_id", F.struct(
        F.col("turn").isNull().alias("last"), "turn", "role", _digest(F.col("role"), F.col("text")).alias("digest"),
        "rendered", "level").alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    rows = rows.select("conv_id", "t", F.array_join(F.transform("t", lambda x: x.rendered), "").alias("formatted"))
    rows = rows.withColumn("back", parsed(F.col("formatted")))
    same = (F.transform("back", lambda b: _digest(b.role, b.text)) == F.transform("t", lambda x: x.digest))
    formatted = F.when(same, F.col("formatted")).otherwise(F.raise_error(F.lit("a formatted conversation did not come back")).cast("string"))
    loss = F.filter(F.transform("back", lambda b, i: F.struct(i.alias("turn"), b.start.alias("start"), b.length.alias("length"), b.role.alias("role"))),
                    lambda x: x.role == learnt)
    return rows.select("conv_id", formatted.alias("formatted"), F.size(F.filter("t", lambda x: x.level > 0)).alias("n_escaped"),
                       F.transform(loss, lambda x: F.struct(x.turn.alias("turn"), x.start.alias("start"), x.length.alias("length"))).alias("loss"))


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return let(segments(formatted), lambda s: F.array_join(
        F.transform(loss, lambda x: unescaped(F.substring(s[x.turn], x.start, x.length))), ""))


ORACLE_12 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
n AS (
  SELECT *, sha256(role || chr(10) || text) AS digest, length(text) - length(replace(text, '\', '')) AS slashes,
    coalesce(list_sum(list_transform(regexp_extract_all(text, '#{3,}'), lambda x: length(x) - 2)), 0)
      + (length(text) - length(replace(text, '</turn>', ''))) / 7 AS marks FROM c),
s AS (
  SELECT *, length(text) + CASE WHEN regexp_matches(text, '(?s)\\.') THEN marks + slashes ELSE marks END
    + 14 + length(role) + length(regexp_replace(role, '[^\\:#<]', '', 'g')) AS size FROM n)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, digest)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, digest) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(size)::BIGINT AS formatted_chars
FROM s GROUP BY conv_id"""


@query("op12_chat_format", ORACLE_12)
def op12_chat_format(spark, folder):
    """Every conversation and the one numbered -7, with digests of what the formatted text gives back.

    Nulls, repeated rows and empty tables as in ``format_chat``; conversation -7 is there even if the table is empty.
    """
    turns = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    odd = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, LEARNT, odd)], "conv_id bigint, turn bigint, role string, text string")
    out = format_chat(turns.unionByName(extra)).withColumn("back", parsed(F.col("formatted")))
    out = out.withColumn("learnt", loss_text(F.col("formatted"), F.col("loss")))
    all_turns = F.array_join(F.transform("back", lambda b: F.concat(b.role, F.lit("\n"), b.text, F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("back").cast("long").alias("n_turns"), F.sha2(all_turns, 256).alias("turns_sha256"),
        F.char_length("learnt").cast("long").alias("loss_chars"), F.sha2("learnt", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))
