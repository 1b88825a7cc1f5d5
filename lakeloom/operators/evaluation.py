"""Scores of evaluated answers and of the answer log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.numbers import count_if, exact_avg, pct
from lakeloom.operators.aggregates import exact_percentile


def eval_summary(results: DataFrame, keys: list[str]) -> DataFrame:
    """Cases, accuracy, mean recall, precision, relevance and seconds per group."""
    n = F.count(F.lit(1))
    return results.groupBy(*keys).agg(
        n.alias("total_cases"), pct(count_if(F.col("is_correct")), n).alias("accuracy_pct"),
        F.round(exact_avg("recall_score") * 100, 1).alias("avg_recall_pct"),
        F.round(exact_avg("precision_score") * 100, 1).alias("avg_precision_pct"),
        F.round(exact_avg("relevance_score"), 2).alias("avg_relevance_score"),
        F.round(exact_avg("response_sec"), 2).alias("avg_response_sec"))


def eval_compare(results: DataFrame) -> DataFrame:
    """One row per tool type. Category shares divide by all cases, as the declared query does."""
    n = F.count(F.lit(1))
    cat = F.col("category")
    g = results.groupBy("tool_type").agg(
        pct(count_if(cat.isin("A", "B") & F.col("is_correct")), n).alias("impact_accuracy_pct"),
        F.round(exact_avg(F.when(cat.isin("C", "D"), F.col("relevance_score"))), 2).alias("code_search_score"),
        pct(count_if((cat == "E") & F.col("tool_match")), n).alias("tool_routing_accuracy_pct"))
    p = exact_percentile(results, ["tool_type"], "response_sec", 0.95, "p95")
    return g.join(p, "tool_type").withColumn("p95_response_sec", F.round("p95", 2)).drop("p95")


def improvement(summary: DataFrame, keys: list[str], value: str, base: str, other: str) -> DataFrame:
    """Value of two tool types side by side and their difference."""
    def pick(tool):
        return F.max(F.when(F.col("tool_type") == tool, F.col(value)))
    return summary.groupBy(*keys).agg(pick(base).alias(base), pick(other).alias(other)).withColumn(
        "difference", F.round(F.col(other) - F.col(base), 2))


def case_diff(results: DataFrame, base: str, other: str) -> DataFrame:
    """Outcome change of every case between two tool types, without a self join."""
    def ok(tool):
        return F.max(F.when(F.col("tool_type") == tool, F.col("is_correct")))
    g = results.groupBy("test_case_id", "category").agg(ok(base).alias("base_ok"), ok(other).alias("other_ok"))
    return g.withColumn("outcome", F.when(F.col("base_ok") & ~F.col("other_ok"), "worse")
                        .when(~F.col("base_ok") & F.col("other_ok"), "better").otherwise("same"))


def daily_stats(log: DataFrame) -> DataFrame:
    """Answer log per day."""
    return log.groupBy(F.to_date("logged_at").alias("date")).agg(*daily_columns())


def daily_columns() -> list:
    return [F.count(F.lit(1)).alias("query_count"),
            F.round(exact_avg("max_similarity"), 4).alias("avg_max_similarity"),
            F.round(exact_avg("latency_ms"), 0).alias("avg_latency_ms"),
            count_if(F.col("user_feedback") == "good").alias("good_count"),
            count_if(F.col("user_feedback") == "bad").alias("bad_count")]


def answer_from_events(lines: DataFrame, key: list[str], seq: str, line: str) -> DataFrame:
    """Answer text and used tools from the ``data:`` lines of a reply stream.

    Lines that are not data or not valid JSON are skipped; everything from [DONE] on is ignored.
    """
    schema = "type string, name string, delta struct<type: string, text: string>"
    x = lines.where(F.startswith(F.col(line), F.lit("data: "))).withColumn("_d", F.substr(F.col(line), F.lit(7)))
    x = x.withColumn("_e", F.from_json("_d", schema))
    e = F.col("_e")
    text = F.when((e["type"] == "content_block_delta") & (e["delta"]["type"] == "text_delta"), F.coalesce(e["delta"]["text"], F.lit("")))
    tool = F.when(e["type"] == "tool_use", F.coalesce(e["name"], F.lit("")))
    x = x.select(*key, F.col(seq).alias("_q"), text.alias("_t"), tool.alias("_n"), (F.col("_d") == "[DONE]").alias("_done"))
    g = x.groupBy(*key).agg(
        F.min(F.when(F.col("_done"), F.col("_q"))).alias("_end"),
        F.sort_array(F.collect_list(F.when(F.col("_t").isNotNull() | F.col("_n").isNotNull(), F.struct("_q", "_t", "_n")))).alias("_p"))
    live = F.filter("_p", lambda p: F.col("_end").isNull() | (p["_q"] < F.col("_end")))
    return g.select(*key, F.array_join(F.transform(live, lambda p: F.coalesce(p["_t"], F.lit(""))), "").alias("answer"),
                    F.array_compact(F.transform(live, lambda p: p["_n"])).alias("used_tools"))
