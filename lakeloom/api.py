"""User-callable jobs: search, upkeep of the index, logging, named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.operators import chunking, keyword, retrieval, vectors
from lakeloom.operators.dml import delete_cascade, stable_id
from lakeloom.operators.encoders import embed_hashing
from lakeloom.operators.joins import insert_missing
from lakeloom.sources.writers import insert_select

Encoder = Callable[[DataFrame, list[str], str], DataFrame]
NO_DATA = "no rows"


def default_encoder(df: DataFrame, key: list[str], text: str) -> DataFrame:
    return embed_hashing(df, key, text, 256)


def rag_search(chunks: DataFrame, questions: DataFrame, top_k: int = 3, threshold: float = 0.5,
               encoder: Encoder = default_encoder) -> DataFrame:
    """Context of each question, or the not-found message.

    ``chunks`` has chunk_no (integer), doc_name, chunk_text and vec; ``questions`` has
    question_id and question. Every question gives one row.
    """
    q = encoder(questions, ["question_id"], "question").withColumnRenamed("vec", "qvec")
    hits = vectors.topk(chunks, "chunk_no", "vec", q, "question_id", "qvec", top_k, threshold)
    text = chunks.select(F.col("chunk_no").alias("item_id"), "doc_name", "chunk_text")
    ctx = retrieval.context_text(hits.join(text, "item_id"), ["query_id"])
    best = hits.groupBy("query_id").agg(F.max("score").alias("max_score"))
    out = questions.join(ctx.join(best, "query_id").withColumnRenamed("query_id", "question_id"), "question_id", "left")
    answer = F.coalesce(retrieval.prompt("question"), F.lit(retrieval.NOT_FOUND))
    return out.select("question_id", "question", "max_score", F.col("context_text").isNotNull().alias("found"), answer.alias("prompt"))


def search_with_sources(docs: DataFrame, questions: DataFrame, department: str | None = None, n: int = 3) -> DataFrame:
    """Keyword search of whole documents with a source list per question.

    ``docs`` has doc_id, doc_name, department and text.
    """
    spec = {"@eq": {"department": department}} if department else None
    d = docs.where(retrieval.filter_column(spec))
    hits = keyword.bm25_topk(d, "doc_id", "text", questions, "question_id", "question", n)
    named = hits.join(d.select("doc_id", "doc_name", "department"), "doc_id")
    return retrieval.source_structs(named, ["query_id"], ["doc_name", "department", "score"]).withColumnRenamed("query_id", "question_id")


def process_new_documents(docs: DataFrame, vectors_table: DataFrame, encoder: Encoder = default_encoder) -> DataFrame:
    """Vectors of chunks that have none yet: (chunk_id, doc_id, chunk_index, vec)."""
    chunks = chunking.chunk_lines(docs, ["doc_id"], "text").withColumn("chunk_id", stable_id("doc_id", "chunk_index"))
    new = insert_missing(chunks, vectors_table.select("chunk_id"), "chunk_id")
    return encoder(new, ["chunk_id", "doc_id", "chunk_index"], "chunk_text")


def delete_document(docs: DataFrame, name: str, *children: DataFrame):
    """Remaining documents and children, and the number of deleted rows of the first child."""
    rest, kept, gone = delete_cascade(docs, F.col("doc_name") == name, "doc_id", *children)
    return rest, kept, gone[0].count()


def log_query(log_path: str, rows: DataFrame) -> None:
    """Append answers to the quality log; key and time are filled in."""
    cols = ["log_key", "query", "answer", "max_similarity", "avg_similarity", "model_used", "latency_ms", "user_feedback", "logged_at"]
    insert_select(rows, log_path, cols, {
        "log_key": F.uuid(), "logged_at": F.current_timestamp(), "user_feedback": F.lit(None).cast("string")})


def execute_or_message(spark: SparkSession, sql: str, message: str = NO_DATA) -> DataFrame:
    """Result of a query, or one message row if it is empty."""
    df = spark.sql(sql)
    return spark.range(1).select(F.lit(message).alias("message")) if df.isEmpty() else df


def run_named(spark: SparkSession, names: list[str], table: dict[str, Callable[[], DataFrame]], message: str = NO_DATA) -> DataFrame:
    """Several stored queries in one call: rows (name, result) with each row of a result as JSON."""
    out = None
    for name in names:
        df = table[name]() if name in table else None
        if df is None or df.isEmpty():
            part = spark.range(1).select(F.lit(name).alias("name"), F.lit(message).alias("result"))
        else:
            part = df.select(F.lit(name).alias("name"), F.to_json(F.struct(*df.columns)).alias("result"))
        out = part if out is None else out.unionByName(part)
    return out


def describe_tables(spark: SparkSession, names: list[str]) -> DataFrame:
    """Columns of tables or views with their row counts."""
    out = None
    for name in names:
        df = spark.table(name)
        cols = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(x.name).alias("column_name"),
                                  F.lit(x.dataType.simpleString()).alias("data_type")) for i, x in enumerate(df.schema.fields)])
        part = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows", F.inline(cols))
        out = part if out is None else out.unionByName(part)
    return out
