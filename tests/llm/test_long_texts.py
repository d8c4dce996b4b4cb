"""Texts of tens of thousands of words go through whole."""

import hashlib
import random

import numpy as np
import xxhash

from knowntime.llm import language_model, simhash, substring_dedup, weak_labels

WORDS = 40_000


def long_text(seed):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(WORDS))


def test_substrings_of_a_long_text(spark):
    text, own = long_text(1), long_text(2).split()
    later = " ".join(own[:1000] + text.split()[20_000:] + own[1000:])
    df = spark.createDataFrame([(1, text), (2, text + " end"), (3, later)], "doc_id long, text string")
    got = {r.doc_id: r for r in substring_dedup.repeated_windows(df).collect()}
    assert [(got[i].n_words, got[i].n_removed) for i in (1, 2, 3)] == [(WORDS, 0), (WORDS + 1, WORDS), (WORDS + 20_000, 20_000)]
    assert got[2].kept_sha256 == hashlib.sha256(b"end").hexdigest() and got[3].kept_sha256 == hashlib.sha256(" ".join(own).encode()).hexdigest()


def test_fingerprint_of_a_long_text(spark):
    texts = [long_text(3), long_text(3) + " more", "short"]
    got = {r.doc_id: (r.fps[0] & (1 << 64) - 1, r.component_id) for r in simhash.near_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 4, 4).collect()}
    for i, t in enumerate(texts[:2]):
        w = t.encode().split()
        h = np.array([xxhash.xxh64_intdigest(b" ".join(w[a : a + 4]), 42) for a in range(len(w) - 3)], np.uint64)
        assert got[i][0] == sum(1 << b for b in range(64) if 2 * int((h >> np.uint64(b) & np.uint64(1)).sum()) > len(h))
    assert got[1][1] == 0 and got[2][1] == 2


def test_quality_of_a_long_text_is_that_of_its_words(spark):
    rng = random.Random(5)
    line = lambda: " ".join(rng.choices([f"word{i}" for i in range(400)], k=14)) + ".\n"
    rows = [(i, "".join(line() for _ in range(6)) if i % 4 else "%%% " * 60) for i in range(80)] + [(100, "".join(line() for _ in range(3000))), (101, "%%% " * WORDS)]
    out = {r.doc_id: r.keep for r in weak_labels.quality_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[100] and not out[101]


def test_likelihood_of_a_long_text(spark):
    text = long_text(6)
    rows = [(i, " ".join(text.split()[i * 100 : i * 100 + 100])) for i in range(20)] + [(50, text)]
    out = {r.doc_id: r for r in language_model.likelihoods(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=100_000).collect()}
    assert out[50].n_tokens == WORDS + 1 and out[0].n_tokens == 101
    counts, n = {}, 0
    for _, t in rows:
        for w in [*t.split(), ""]:
            counts[w] = counts.get(w, 0) + 1
            n += 1
    base = sum(np.log10((counts[w] + 1) / (n + len(counts) + 1)) for w in [*text.split(), ""])
    assert abs(out[50].base_score - base) < 1e-6 * abs(base) and np.isfinite(out[50].score)
