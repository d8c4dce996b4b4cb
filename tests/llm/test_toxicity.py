import math
import os
import random
import zlib

import numpy as np
import pytest

from knowntime.llm import toxicity
from knowntime.llm.sampling import parts

SF = "/root/testdata/sf0.01"


def test_gradients():
    net = toxicity.Net(3)
    rng = np.random.default_rng(4)
    net.p = {k: (v + rng.normal(size=v.shape) * 0.1).astype(np.float64) for k, v in net.p.items()}
    inputs = toxicity.Inputs([b"one two three fourfour", b"fivefivefive six, seven! two", b"x"])
    part = inputs.part(np.arange(len(inputs.slot)))
    n = len(inputs.slot)
    at = rng.integers(0, n, (4, 6))
    at[1, 4:], at[2, :] = -1, -1
    y = np.array([1, 0, 1, 0])

    def loss():
        z = net.forward(net.inputs(*part), at).astype(float)
        return np.mean(np.log1p(np.exp(z)) - y * z)

    grads = net.gradients(part, at, y)
    for name in ("Wf", "Ub", "cf", "A", "v", "o", "k", "words", "runs"):
        g = grads[name]
        if isinstance(g, tuple):
            dense = np.zeros_like(net.p[name])
            dense[g[0]] = g[1]
            spots = np.flatnonzero(dense.reshape(-1))[:: max(1, np.count_nonzero(dense) // 5)][:5]
            g = dense
        else:
            spots = rng.integers(0, g.size, 4)
        flat = net.p[name].reshape(-1)
        for i in spots:
            old = flat[i]
            flat[i] = old + 1e-4
            up = loss()
            flat[i] = old - 1e-4
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-4 - g.reshape(-1)[i]) < 1e-4


def plain_logit(net, words):
    """The network on one window, one number at a time."""
    p, H = {k: v.astype(float) for k, v in net.p.items()}, toxicity.HIDDEN
    if not words:
        return float(p["k"][0])

    def squash(x):
        return 1 / (1 + np.exp(-x))

    rows = []
    for w in words:
        inputs = toxicity.Inputs([w])
        framed, runs = b" " + w + b" ", []
        for size in toxicity.RUNS:
            for i in range(max(1 if size == toxicity.RUNS[0] else 0, len(framed) - size + 1)):
                run = (framed + b"     ")[i : i + size]
                slot = toxicity.mix(np.array([int.from_bytes(run, "little") + size], np.uint64))[0] % np.uint64(toxicity.RUN_SLOTS)
                runs.append(p["runs"][int(slot)])
        rows.append(np.concatenate((np.max(runs, 0), p["words"][inputs.slot[0]])))
    both = []
    for d, order in (("f", range(len(rows))), ("b", reversed(range(len(rows))))):
        h, states = np.zeros(H), {}
        for t in order:
            g, u = rows[t] @ p[f"W{d}"] + p[f"c{d}"], h @ p[f"U{d}"]
            z, r = squash(g[:H] + u[:H]), squash(g[H : 2 * H] + u[H : 2 * H])
            c = np.tanh(g[2 * H :] + r * u[2 * H :])
            h = states[t] = c + z * (h - c)
        both.append([states[t] for t in range(len(rows))])
    states = [np.concatenate(x) for x in zip(*both)]
    e = [math.exp(float(np.tanh(s @ p["A"]) @ p["v"])) for s in states]
    return float(sum(a / sum(e) * (s @ p["o"]) for a, s in zip(e, states)) + p["k"][0])


def test_scores_are_those_of_a_plain_loop():
    rng, net = random.Random(1), toxicity.Net(5)
    vocab = [b"a", b"of", b"word", "\u00e9t\u00e9".encode(), b"longerword", b"x1"]
    texts = [b" ".join(rng.choices(vocab, k=n)) for n in (1, 5, 31, 32, 33, 48, 49, 100)] + [b"", b" ,."]
    for text, got in zip(texts, toxicity.worst(net, texts)):
        w = text.split() if text.strip(b" ,.") else []
        starts = [0]
        while starts[-1] + toxicity.WINDOW < len(w):
            starts.append(starts[-1] + toxicity.STRIDE)
        want = max(plain_logit(net, w[s : s + toxicity.WINDOW]) for s in starts)
        assert abs(got - want) < 1e-4


def test_windows_cover_every_word():
    inputs = toxicity.Inputs([b"a " * 70, b"", b"x y z", b"q " * 32, b"q r " * 17])
    at, doc = inputs.windows()
    for d in range(5):
        seen = set(at[doc == d].ravel().tolist()) - {-1}
        assert seen == set(inputs.of[inputs.first[d] : inputs.first[d + 1]].tolist())
    assert (np.bincount(doc) >= 1).all()


def test_held_out(spark):
    rng = random.Random(5)
    vocab = [f"{a}{b}" for a in ("ba", "ke", "lo", "mi", "tu") for b in ("na", "ro", "si", "ve", "po", "ga")]
    def text(bad):
        w = rng.choices(vocab, k=rng.randint(5, 120))
        for _ in range(3 * bad):
            w.insert(rng.randrange(len(w)), rng.choice(["zorg", "vexx" + rng.choice(["on", "ta", "il"])]) + rng.choice(["", ",", "."]))
        return " ".join(w)
    rows = [(i, text(i % 4 == 0), "x") for i in range(600)] + [(600, None, "x"), (601, "", "x"), (None, "bana", "x"), (3, "again", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0) if i % 11 else None) for i in range(0, 600)], "doc_id long, toxic int")
    out = toxicity.toxicity_scores(docs, labels, train=toxicity.F.col("_id") % 5 != 0).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    held = [(r.doc_id % 4 == 0, r.score >= 0.5) for r in out if r.doc_id is not None and r.doc_id % 5 == 0 and r.doc_id < 600]
    assert sum(a == b for a, b in held) / len(held) > 0.95
    assert toxicity.toxicity_scores(docs, labels.limit(0)).count() == len(rows)
    assert toxicity.toxicity_scores(docs.limit(0), labels).count() == 0


def test_long_and_null_texts_are_fitted(spark):
    rng = random.Random(6)
    vocab = [f"{a}{b}" for a in ("ba", "ke", "lo", "mi", "tu") for b in ("na", "ro", "si", "ve", "po", "ga")]

    def text(bad, n):
        w = rng.choices(vocab, k=n)
        for _ in range(n // 40 * bad):
            w.insert(rng.randrange(len(w)), "zorg")
        return " ".join(w)

    # A limit of 4 KB a text; all toxic ones are longer, or null, and then those of both labels are.
    for clean in (60, 2000):
        rows = [(i, text(i % 3 == 0, 2000 if i % 3 == 0 else clean)) for i in range(150)] + [(150, None), (153, None)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int")
        out = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, labels, train=toxicity.F.col("_id") % 5 != 0, fit_bytes=128 << 10).collect()}
        held = [(i % 3 == 0) == (out[i] >= 0.5) for i in range(0, 150, 5)]
        assert len(out) == len(rows) and sum(held) >= 0.9 * len(held)


def test_parts():
    text = b"".join(b"%07d " % i for i in range(5000))
    assert parts(text, 1 << 20) == text
    got = parts(text, 10_000)
    assert 8000 <= len(got) <= 10_000 and got.startswith(b"0000000") and b"0002500" in got


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_held_out_labels_of_the_tables(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    fifth = toxicity.F.crc32(toxicity.F.col("_id").cast("string").cast("binary")) % 5
    scores = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, labels, train=fifth != 0).collect()}
    held = [(scores[r.doc_id], r.toxic) for r in labels.where("toxic in (0, 1)").collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    bad, fine = ([s for s, y in held if y == k] for k in (1, 0))
    auc = sum((a > b) + (a == b) / 2 for a in bad for b in fine) / (len(bad) * len(fine))
    assert auc > 0.9 and sum(s >= 0.5 for s in fine) <= 0.05 * len(fine)


def test_columns_of_any_name(spark):
    rows = [(i, "zorg bad" if i % 2 else "a fine text", i, "y") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score long, _toxicity string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    left = toxicity.drop_toxic(docs, labels)
    assert left.columns == docs.columns and {r.doc_id % 2 for r in left.collect()} == {0}
