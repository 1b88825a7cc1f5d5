"""Corpus pipeline over ``documents``: quality rules, near-dedup, substring dedup, mixing, packing.

Each stage works on all rows that the one before kept and is written as Parquet before the next reads
it. All but the last return the columns of their input. Not expressible in SQL as a whole (signatures,
parsing, tokenizer), so the stages are tested against brute force in tests/llm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import mixing, neardup, packing, quality, substrings
from lakeloom.llm.base import documents, staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the log-ratio threshold."""
    ratios = quality.log_ratios(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.scored(docs, ratios).where("kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: its first in order of doc_id; of repeated rows one stays."""
    return neardup.first_of_class(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur earlier; ``n_chars`` follows the text, empty ones go."""
    rows, _ = substrings.dedup(docs)
    out = rows.where("n_removed = 0 or n_words > n_removed").select("row.*", "n_removed")
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast(kind))
    return out.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by calibrated probabilities."""
    return mixing.mix(docs).where("kept").select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their ids, sequence and offset."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each staged in the shared folder but the last."""
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, name)
    return docs
