import math
import random
from collections import Counter

import numpy as np

from knowntime.llm import language_model as lm


def toks(t):
    return [*(t or "").encode().lower().split(), b"\n"]


def corpus():
    rng = random.Random(7)
    a, b = [f"a{i}" for i in range(50)], [f"b{i}," for i in range(50)]
    rows = [(i, " ".join(rng.choices(a if i % 2 else b, k=rng.randint(1, 90))), "x") for i in range(150)]
    return [*rows, (150, None, "x"), (151, "", "x"), (152, "unseen É words. here", "x"), (152, "unseen É words. here", "x"), (None, "a1 B2, a3", "x")]


def test_counts_and_scores(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    train = lm.F.coalesce(lm.F.col("doc_id") % 3 != 0, lm.F.lit(True))
    out = lm.likelihoods(df, train=train, block_bytes=2000, least_share=0.005, fit_share=1.0).collect()
    c = Counter(w for i, t, _ in rows if i is None or i % 3 for w in toks(t))
    total, distinct = sum(c.values()), len(c)
    want = sorted((i if i is not None else -1, len(toks(t)), sum(w in c for w in toks(t)), round(sum(math.log10((c[w] + 1) / (total + distinct + 1)) for w in toks(t)), 6)) for i, t, _ in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in out) == want
    assert all(r.train_tokens == total and r.score < 0 and math.isfinite(r.score) for r in out)
    held = [r for r in out if r.doc_id is not None and r.doc_id % 3 == 0 and r.doc_id < 150]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert lm.likelihoods(df.limit(0)).count() == 0


def model():
    m = lm.Model([("the", 40), ("a", 20), ("b", 9), (lm.END, 30)], {0: (10, 3), 4: (5, 5)}, 114, 12, 1)
    rng = np.random.default_rng(2)
    m.p = {k: (v + rng.normal(size=v.shape) * 0.1).astype(np.float64) for k, v in m.p.items()}
    return m


def test_probabilities_sum_to_one():
    m = model()
    for prefix in ([], [0], [3, 2, 21]):
        total = 0.0
        for nxt in range(m.k + lm.FORMS):
            total += math.exp(m.log_likelihoods([np.array([*prefix, nxt])])[0])
        whole = math.exp(m.log_likelihoods([np.array(prefix)])[0]) if prefix else 1.0
        assert abs(total / whole - 1) < 1e-6


def test_state_is_carried_and_lanes_agree():
    m, rng = model(), np.random.default_rng(3)
    codes = [rng.integers(0, m.k + lm.FORMS, n) for n in (1, 5, 200, 70, 3, 3)]
    alone = [m.log_likelihoods([c])[0] for c in codes]
    assert np.allclose(alone, m.log_likelihoods(codes, lanes=2, chunk=7))


def test_lanes_at_their_end_are_not_carried_on(monkeypatch):
    m, rng, rows = model(), np.random.default_rng(3), []
    codes = [rng.integers(0, m.k + lm.FORMS, n) for n in (2000, *[10] * 30)]
    step = lm.Model.step
    monkeypatch.setattr(lm.Model, "step", lambda self, g, h: rows.append(len(h)) or step(self, g, h))
    m.log_likelihoods(codes, lanes=31, chunk=16)
    # One window more a lane at most; 31 * 2000 if all lanes ran to the end of the longest.
    assert sum(rows) <= 2300 + 31 * 16


def test_gradients():
    m, rng = model(), np.random.default_rng(5)
    stream = rng.integers(0, m.k + lm.FORMS, (6, 3))
    target, fresh = rng.integers(0, m.k + lm.FORMS, (6, 3)), rng.random((6, 3)) < 0.2
    h0 = rng.normal(size=(3, lm.HIDDEN)) * 0.1
    kept = {}

    class Keep:
        def step(self, grads):
            kept.update(grads)

    def loss():
        h, total = h0, 0.0
        for t in range(6):
            h = m.step(m.p["E"][stream[t]] @ m.p["W"] + m.p["c"], np.where(fresh[t][:, None], 0, h))[0]
            total -= m.output(h, target[t]).sum()
        return total / 18

    m._update(stream, target, fresh, h0, Keep())
    size = 1.0
    for name in ("U", "W", "C", "V", "d", "c"):
        flat = m.p[name].reshape(-1)
        for i in rng.integers(0, flat.size, 4):
            old = flat[i]
            flat[i] = old + 1e-4
            up = loss()
            flat[i] = old - 1e-4
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-4 - size * kept[name].reshape(-1)[i]) < 1e-4


def test_forms_agree(spark):
    words = ["a", "abcdef.", "é,", "longwordlongword", "x" * 9, "x" * 10 + ",", "ñ" * 5]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    assert [r[0] for r in df.select(lm.form_of(lm.F.col("word"))).collect()] == [lm.form(w.encode()) for w in words]


def naive(m, text, known):
    """log10 probability of a text, one token and one number at a time."""
    h, out, before = [0.0] * lm.HIDDEN, 0.0, lm.END.encode()
    p = {k: v.astype(float) for k, v in m.p.items()}

    def squash(x):
        return 1 / (1 + math.exp(-x))

    for word in toks(text):
        x = p["E"][m.code(before)] @ p["W"] + p["c"]
        u = np.array(h) @ p["U"]
        H = lm.HIDDEN
        z, r = [squash(v) for v in x[:H] + u[:H]], [squash(v) for v in x[H : 2 * H] + u[H : 2 * H]]
        c = [math.tanh(x[2 * H + i] + r[i] * u[2 * H + i]) for i in range(H)]
        h = [c[i] + z[i] * (h[i] - c[i]) for i in range(H)]
        code = m.code(word)
        cls = code // lm.CLASS_SIZE if code < m.k else m.classes + code - m.k
        logits = np.array(h) @ p["C"] + p["d"]
        out += logits[cls] - math.log(sum(math.exp(v) for v in logits))
        if code < m.k:
            inner = np.array(h) @ p["V"][cls] + p["w"][cls]
            out += inner[code % lm.CLASS_SIZE] - math.log(sum(math.exp(v) for v in inner))
        else:
            out += math.log((known.get(word, 0) + 1) / m.form_size[code - m.k])
        before = word
    return out / math.log(10)


def test_scores_are_those_of_a_plain_loop(spark):
    rows = [(i, t) for i, t, _ in corpus() if i is not None][:60] + [(900, None), (901, "word " * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    counts = lm.token_counts(df.select(lm.F.coalesce("text", lm.F.lit("")).alias("text")))
    known = {r.word.encode(): r.n for r in counts.collect()}
    m = lm.untrained(counts, 0.005, 1)
    lm.learn(m, df.select(lm.F.coalesce("text", lm.F.lit("")).alias("text"), lm.F.xxhash64("doc_id").alias("place")), fit_share=1.0)
    got = {r.doc_id: r.score for r in _scored_with(m, df, counts)}
    for i, t in rows:
        assert abs(got[i] - naive(m, t, known)) < 1e-3 * max(1.0, abs(got[i]))


def _scored_with(m, df, counts):
    learn, untrained = lm.learn, lm.untrained
    try:
        lm.learn, lm.untrained = (lambda *a, **k: None), (lambda *a, **k: m)
        return lm.likelihoods(df, block_bytes=4000).collect()
    finally:
        lm.learn, lm.untrained = learn, untrained


def test_learning_grows_with_the_corpus_and_agrees_again(spark):
    rows = [(i, t) for i, t, _ in corpus()]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("place", lm.F.xxhash64("doc_id", "text"))
    counts = lm.token_counts(df.na.fill(""))
    made = []
    for parts in (1, 7):
        m = lm.untrained(counts, 0.005, 1)
        lm.learn(m, df.na.fill("").repartition(parts), fit_share=1.0, task_bytes=1000)
        made.append(m.weights())
    assert np.allclose(np.frombuffer(made[0], np.float32), np.frombuffer(made[1], np.float32), atol=1e-5)
    assert made[0] != lm.untrained(counts, 0.005, 1).weights()


def test_all_training_texts_are_learnt_from(spark, monkeypatch):
    from knowntime.llm import language_model as lm

    taken, stage_at = [], lm.stage_at

    def seen(df, label):
        out = stage_at(df, label)
        if label == "lessons":
            taken.append(out[0].count())
        return out

    monkeypatch.setattr(lm, "stage_at", seen)
    docs = spark.range(40).selectExpr("id as doc_id", "concat('word ', id % 3, ' and more') as text")
    assert lm.likelihoods(docs).count() == 40 and taken == [40]
