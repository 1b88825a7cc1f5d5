"""Pipeline stages: columns, decisions that take effect, and the query as a whole."""

import corpus_pipeline as pipeline
import pytest
from conftest import ODD

from lakeloom.llm.base import staged

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before, columns = docs.count(), docs.columns
    for name, stage in pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, FOLDER), name)
        now = docs.count()
        assert docs.columns == columns and 0 < now <= before
        before = now
    packed = pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert {r[0] for r in packed.select("doc_id").distinct().collect()} == {r[0] for r in docs.select("doc_id").collect()}


@pytest.mark.parametrize("rows", [ODD, []])
def test_odd_input(spark, docs, rows):
    df = docs(rows, extra=("row", "k", "kept"))
    for _, stage in pipeline.STAGES:
        stage(spark, df, FOLDER).collect()
