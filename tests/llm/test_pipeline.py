"""The pipeline on the smallest tables: each stage against what it is told to do."""

import os

import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    seen = docs
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, seen, SF).cache()
        assert out.columns == docs.columns, name
        if name != "mixing sources to target weights":
            assert out.count() == out.select("doc_id").distinct().count() <= seen.count()
        assert out.join(docs, "doc_id", "left_anti").count() == 0
        if name == "line dedup":
            assert out.count() == seen.count()
            assert out.where(F.char_length("text") != F.col("n_chars")).count() == 0
        seen = out
    assert seen.count() > 0
