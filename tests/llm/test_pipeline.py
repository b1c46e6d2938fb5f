from __future__ import annotations

import corpus_pipeline
import pytest
from peerbench.llm.registry import QUERIES, SQL
from tests.llm.corpus import SCHEMA, corpus

SMALL = "/root/testdata/sf0.001"


def test_registered():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)} and set(SQL) <= set(QUERIES)
    import __spark_entry__

    assert {*QUERIES, "pipeline"} <= set(__spark_entry__.queries())


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SMALL)
        assert after.columns == docs.columns + (["taken"] if name == "mixing" else [])
        if name != "line dedup":
            kept = {tuple(r) for r in after.select("doc_id", "text").collect()}
            assert kept <= {tuple(r) for r in docs.select("doc_id", "text").collect()} and len(kept) > 0.6 * docs.count()
        docs = after
    assert docs.where("taken <= 0").count() == 0


def test_odd_rows_and_names(spark):
    rows = [(*r, i, "t", "d") for i, r in enumerate(corpus(9))]
    docs = spark.createDataFrame(rows, SCHEMA + ", taken int, tk string, `doc.x` string")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        empty = stage(spark, docs.limit(0), SMALL)
        assert empty.count() == 0 and "doc.x" in docs.columns
    assert docs.columns.count("taken") == 1


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_queries_run(spark, name):
    assert QUERIES[name](spark, SMALL).count() == spark.read.parquet(f"{SMALL}/{'embeddings' if 'op10' in name else 'pages' if 'op8' in name else 'documents'}.parquet").count()
