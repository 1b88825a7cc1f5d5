"""Search requests, row access, and the text built from search results."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labels and messages that appear in results.
SUMMARY_LABELS = {
    "module_name": " モジュール名: ",
    "function_name": " 機能名: ",
    "file_name": " ファイル名: ",
    "ajs_name": " ジョブ名: ",
}
NOT_FOUND = "申し訳ありませんが、関連する情報が見つかりませんでした。"
DOC_OPEN, DOC_CLOSE = "【", "】"
SIMILARITY_LABEL = " (類似度: "
CONTEXT_HEADER = "=== 参考文書 ===\n"
QUESTION_HEADER = "\n\n=== 質問 ===\n"
STRUCTURED_HEADER = "【構造化データ集計結果】\n"
RELATED_HEADER = "【関連ドキュメント】\n"


def search_content(summary: str = "ai_summary", labels: dict[str, str] | None = None) -> Column:
    """Summary followed by labelled names; NULL when there is no summary."""
    parts = [F.col(summary)]
    for col, label in (labels or SUMMARY_LABELS).items():
        parts += [F.lit(label), F.coalesce(F.col(col), F.lit(""))]
    return F.concat(*parts)


def filter_column(spec: dict | str | None) -> Column:
    """Search filter (@eq, @and, @or, nested) as a column; a NULL attribute never matches."""
    if isinstance(spec, str):
        spec = json.loads(spec)
    if not spec:
        return F.lit(True)
    (op, arg), = spec.items()
    if op == "@eq":
        (col, value), = arg.items()
        return F.coalesce(F.col(col) == F.lit(value), F.lit(False))
    if op in ("@and", "@or"):
        parts = [filter_column(a) for a in arg]
        return reduce((lambda a, b: a & b) if op == "@and" else (lambda a, b: a | b), parts)
    raise ValueError(f"unknown filter {op}")


def row_access(df: DataFrame, department: str, mapping: DataFrame, user: str, is_admin: bool = False) -> DataFrame:
    """Rows a user may see: those of the user's departments, all for an administrator.

    Apply it before search, so that hidden rows take no part in scores.
    """
    if is_admin:
        return df
    own = mapping.where(F.col("user_name") == user).select(F.col("department").alias(department))
    return df.join(own, department, "left_semi")


def ordered_text(text: Column, order: list[str], sep: str) -> Column:
    """Texts of a group joined in the given order; NULL for no rows. Use after a top-k only."""
    item = F.struct(*[F.col(o) for o in order], text.alias("_text"))
    parts = F.transform(F.sort_array(F.collect_list(item)), lambda x: x["_text"])
    return F.when(F.count(F.lit(1)) > 0, F.array_join(parts, sep))


def context_text(hits: DataFrame, keys: list[str], name: str = "doc_name", text: str = "chunk_text",
                 rank: str = "rn", sep: str = "\n\n") -> DataFrame:
    """Top chunks of a query as one text with document headers."""
    line = F.concat(F.lit(DOC_OPEN), F.col(name), F.lit(DOC_CLOSE + ": "), F.col(text))
    return hits.groupBy(*keys).agg(ordered_text(line, [rank], sep).alias("context_text"))


def citations(hits: DataFrame, keys: list[str], name: str = "doc_name", text: str = "chunk_text",
              rank: str = "rn", score: str = "score") -> DataFrame:
    """Numbered context and source list."""
    ref = F.concat(F.lit("["), F.col(rank).cast("string"), F.lit("] "))
    body = F.concat(ref, F.lit(DOC_OPEN), F.col(name), F.lit(DOC_CLOSE + ": "), F.col(text))
    src = F.concat(ref, F.col(name), F.lit(SIMILARITY_LABEL), F.format_number(F.col(score), 4), F.lit(")"))
    return hits.groupBy(*keys).agg(
        ordered_text(body, [rank], "\n\n").alias("context_text"),
        ordered_text(src, [rank], " | ").alias("sources"))


def source_structs(hits: DataFrame, keys: list[str], fields: list[str], rank: str = "rn") -> DataFrame:
    """Sources of an answer as an array of structs in rank order, with their number."""
    item = F.struct(F.col(rank).alias("rank"), *fields)
    return hits.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("sources"),
                                   F.count(F.lit(1)).alias("n_sources"))


def prompt(question: str | Column, context: str = "context_text", instruction: str = "") -> Column:
    q = F.col(question) if isinstance(question, str) else question
    return F.concat(F.lit(instruction + CONTEXT_HEADER), F.col(context), F.lit(QUESTION_HEADER), q)


def answer_or_fallback(max_score: str, threshold: float, answer: Column, message: str = NOT_FOUND) -> Column:
    """Message in place of an answer when nothing scores high enough."""
    return F.when(F.col(max_score) >= threshold, answer).otherwise(F.lit(message))


def batch_complete(prompts: DataFrame, key: list[str], prompt_col: str, models: list[str],
                   client: Callable[[str, list[str]], list[str]], retries: int = 2) -> DataFrame:
    """Call a text model for every prompt and model: (key..., model, answer, error).

    ``client(model, prompts)`` gets one batch. A batch that keeps failing is retried row by row,
    so that one bad prompt costs one row.
    """
    rows = prompts.select(*key, prompt_col).withColumn("model", F.explode(F.array(*[F.lit(m) for m in models])))
    types = dict(rows.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in key) + ", model string, answer string, error string"

    def ask(model: str, texts: list[str]) -> list[tuple[str | None, str | None]]:
        for attempt in range(retries + 1):
            try:
                return [(a, None) for a in client(model, texts)]
            except Exception as e:  # the client may raise anything
                err = str(e)
        if len(texts) == 1:
            return [(None, err)]
        return [r for t in texts for r in ask(model, [t])]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for model, g in b.groupby("model", sort=False):
                res = ask(model, g[prompt_col].tolist())
                out = g[[*key, "model"]].copy()
                out["answer"] = [r[0] for r in res]
                out["error"] = [r[1] for r in res]
                yield out

    return rows.mapInPandas(run, schema)
