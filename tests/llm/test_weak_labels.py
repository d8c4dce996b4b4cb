import os
import random

import numpy as np
import pytest

from knowntime.llm import weak_labels


def test_em_recovers_accuracies():
    rng = np.random.default_rng(1)
    truth, right = rng.random(20000) < 0.7, np.array([0.95, 0.8, 0.7, 0.9])
    votes = np.where(rng.random((20000, 4)) < right, truth[:, None], ~truth[:, None]) * 2 - 1
    votes[rng.random((20000, 4)) < 0.2] = 0
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    post, accuracy, prior = weak_labels.expectation_maximisation(patterns, counts.astype(float))
    assert abs(prior - 0.7) < 0.03 and np.abs(accuracy - right).max() < 0.04
    assert ((post[inverse.ravel()] > 0.5) == truth).mean() > 0.93


def good(rng):
    return "\n".join(" ".join(rng.choices([f"word{i}" for i in range(400)], k=14)) + "." for _ in range(6))


def poor(rng, i):
    w = good(rng).replace(".", "").split()
    return [" | ".join(w), " ".join(w).upper().replace(" ", "!! "), "%%% ".join(w), "\n".join(["same line again"] * 40)][i % 4]


def test_scores(spark):
    rng = random.Random(2)
    rows = [(i, good(rng) if i % 4 else poor(rng, i // 4), "x") for i in range(400)] + [(400, None, "x"), (401, "", "x"), (401, "", "x"), (None, good(rng), "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, votes string")
    out = weak_labels.quality_scores(df).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    of = {r.doc_id: r.keep for r in out}
    assert all(of[i] for i in range(400) if i % 4)
    assert sum(of[i] for i in range(0, 400, 4)) < 10
    assert weak_labels.quality_scores(df.limit(0)).count() == 0


def test_long_texts_and_nothing_else(spark):
    rng = random.Random(4)
    rows = [(i, (good(rng) + "\n") * 30 if i % 4 else poor(rng, 0) * 30) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.score for r in weak_labels.quality_scores(df, fit_bytes=48 << 10).collect()}
    assert len(out) == 40 and len(set(out.values())) > 2
    assert np.mean([out[i] for i in out if i % 4]) > np.mean([out[i] for i in out if not i % 4]) + 0.2


def test_memory_of_the_fit(monkeypatch):
    """4 MB of texts are hashed a slab at a time: about 260 MB in one go, and four times as much for the 16 MB of a fit."""
    import tracemalloc

    from knowntime.llm import vectortext

    monkeypatch.setattr(vectortext, "_POWERS", {})
    rng = random.Random(6)
    texts = [good(rng).encode() * 64 for _ in range(110)]
    posterior = np.array([i % 3 / 2 for i in range(len(texts))])
    assert sum(map(len, texts)) > 4_000_000
    tracemalloc.start()
    weak_labels.train_scorer(texts, posterior, rounds=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 160 << 20, peak


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_labels_that_were_never_learnt_from(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = weak_labels.quality_scores(docs).join(labels, "doc_id").where("quality in (0, 1)").collect()
    assert len(rows) > 300 and np.mean([r.keep == (r.quality == 1) for r in rows]) > 0.95
