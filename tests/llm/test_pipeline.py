"""The pipeline's stages on their own input."""

import pytest

import corpus_pipeline
from accordion.llm import common
from conftest import SMALL


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names, sizes = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.written(stage(spark, docs, SMALL), "test")
        assert docs.columns == names
        sizes.append(docs.count())
    assert sizes[0] >= sizes[1] >= sizes[2] == sizes[3] <= sizes[4]
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").where("toxic = 1").collect()}
    kept = {r["doc_id"] for r in docs.collect()}
    assert len(kept & toxic) < 0.4 * len(toxic)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert packed.groupBy("bin_id").sum("n_tokens").where("bin_id is not null and `sum(n_tokens)` > 2048").count() == 0


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stage_of_nothing(spark, stage):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("false")
    assert common.written(stage(spark, docs, SMALL), "test").count() == 0
