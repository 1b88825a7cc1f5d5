"""Document loader: staged files to raw text rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.text import strip_tags


def load_text_files(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """One row per file with its whole text."""
    return spark.read.option("wholetext", True).option("pathGlobFilter", glob).text(path).select(
        F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file_name"), F.col("value").alias("text"))


def html_to_text(pages: DataFrame, html_col: str) -> DataFrame:
    return pages.withColumn("text", strip_tags(html_col)).drop(html_col)


def load_with_extractor(files: DataFrame, extract: Callable[[bytes], str]) -> DataFrame:
    """Files read as ``binaryFile`` rows, text taken by a plug-in (PDF, Office)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"file_name": b["path"].str.rsplit("/", n=1).str[-1],
                                "text": [extract(x) for x in b["content"]]})

    return files.select("path", "content").mapInPandas(run, "file_name string, text string")
