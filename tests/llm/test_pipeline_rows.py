"""Stages of the pipeline on lines and rows that repeat."""

import random

import pytest
from pyspark.sql import functions as F

from test_native import without_repeats

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_repeated_lines_are_cut(spark):
    rng = random.Random(8)
    lines = [f"a line of some length, number {i}" for i in range(9)] + ["", "short", "tiny"]
    texts = ["\n".join(rng.choices(lines, k=rng.randint(1, 12))) for _ in range(30)] + [None, "", "the whole of a licence\nown one", "other\nthe whole of a licence\n\nown two"]
    docs = list(enumerate(texts))
    df = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, n_chars long")
    got = corpus_pipeline.line_dedup(spark, df, "")
    assert {r.doc_id: r.text for r in got.collect()} == dict(enumerate(without_repeats(docs, 2)))
    assert got.where("n_chars <> char_length(text)").count() == 0


def test_odd_rows_pass_every_stage(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows, clashing columns, and no rows at all."""
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, None, None, None), (2, "", "a", 0), (3, long, "a", 1), (None, long, "b", 1), (None, None, None, None), (4, "one two", "b", 7), (4, "one two", "b", 7), (5, "zorg is bad", "b", 9)]
    columns = "doc_id long, text string, source string, n_chars long"
    df = spark.createDataFrame(rows, columns)
    for c in ("row", "copies", "cut", "_cut", "_gone", "_hit", "score", "label", "keep", "id", "c0", "size", "place"):
        df = df.withColumn(c, F.lit("own"))
    spark.createDataFrame([(1, "w7 w8 w9 w10 w11 w12 w13 w14 w15 w16 w17"), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, int(i == 5)) for i in range(1, 6)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    want = {"line dedup": 8, "SimHash near-dedup": 4, "benchmark decontamination": 6}
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, df, str(tmp_path))
        assert out.columns == df.columns, name
        found = out.collect()
        assert len(found) == want.get(name, len(found)) and all(r[c] == "own" for r in found for c in df.columns[4:]), name
        assert function(spark, df.limit(0), str(tmp_path)).count() == 0, name


def test_rows_without_an_id_of_their_own(spark, tmp_path):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(2000)]
    texts = [" ".join(rng.choices(vocab, k=rng.randint(5, 60))) for _ in range(90)]
    rows = [(None if i < 40 else i // 3, t, "a" if i % 3 else "b", 0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    passage = " ".join(rng.choices(vocab, k=12))
    leak = spark.createDataFrame([(None, passage, "a", 0), (20, passage, "a", 0)], df.schema)
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert sorted(r.text for r in corpus_pipeline.line_dedup(spark, df, "").collect()) == sorted(texts)
    assert sorted(r.text for r in corpus_pipeline.benchmark_decontamination(spark, df.union(leak), str(tmp_path)).collect()) == sorted(texts)
    mixed = corpus_pipeline.source_mixing(spark, df, "")
    assert mixed.columns == df.columns
    size = lambda rows: sum(len(r[1].split()) for r in rows)
    got = [tuple(r) for r in mixed.collect()]
    # a has weight 3 and is capped at twice its words, or b at twice its own; together 1.5 times all words.
    assert abs(size(got) - 1.5 * size(rows)) <= 2 * 60
    assert all(got.count(r) <= 2 for r in rows) and set(got) <= set(rows)
