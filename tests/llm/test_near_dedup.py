import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from knowntime.llm import near_dedup


def shingles(text, size=5):
    w = (text or "").lower().encode().split()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def kept(rows, similarity):
    """Places of the rows that stay, by all pairs."""
    sets = [shingles(t) for _, t in rows]
    head = list(range(len(rows)))

    def root(i):
        while head[i] != i:
            i = head[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] == sets[j] or both / max(1, len(sets[i] | sets[j])) >= similarity:
                head[root(i)] = root(j)
    best = {}
    for i, (k, _) in enumerate(rows):
        best.setdefault(root(i), []).append((k is None, k or 0, i))
    return [min(v)[2] for v in best.values()]


def corpus():
    """Pairs just above and just below the limit, chains, and a crowd around one text."""
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(3000)]
    texts = []
    for n in range(150):
        base = rng.choices(vocab, k=rng.randint(20, 300))
        texts.append(base)
        for _ in range(2):
            # A changed word breaks five shingles: these lie between similarities of 0.65 and 1.
            w = list(base)
            for at in rng.sample(range(len(w)), max(1, round(len(w) * rng.uniform(0.005, 0.04)))):
                w[at] = rng.choice(vocab)
            texts.append(w)
    crowd = rng.choices(vocab, k=200)
    for _ in range(120):
        w = list(crowd)
        for at in rng.sample(range(200), rng.randint(1, 6)):
            w[at] = rng.choice(vocab)
        texts.append(w)
    rng.shuffle(texts)
    return [" ".join(t) for t in texts] + [None, "", " \n", "one", "One", "a b", "a  B"]


@pytest.mark.parametrize("limits", [None, (3, 4, 5)])
def test_same_as_all_pairs(spark, monkeypatch, limits):
    """Also with components met in blocks from three members on."""
    for name, value in zip(("LARGE", "BLOCK", "ASKING"), limits or ()):
        monkeypatch.setattr(near_dedup, name, value)
    rows = [(i * 7 % 1009, t) for i, t in enumerate(corpus())]
    df = spark.createDataFrame([(i, t, p) for p, (i, t) in enumerate(rows)], "doc_id long, text string, place int")
    want, got = set(kept(rows, 0.8)), {r.place for r in near_dedup.drop_similar(df, 0.8).collect()}
    # What stays beside them is a pair that no band found: about one in 200 near the limit.
    assert len(want) < len(rows) - 150
    assert want <= got and len(got - want) <= 2


def test_recall_of_pairs_near_the_limit(spark):
    """A thousand pairs of a similarity of 0.8 to 0.83, each apart from all other texts."""
    rng, rows = random.Random(9), []
    while len(rows) < 2000:
        base = [str(rng.getrandbits(40)) for _ in range(rng.randint(60, 150))]
        other = list(base)
        for at in rng.sample(range(len(base)), max(1, round(len(base) * 0.0235))):
            other[at] = "changed"
        a, b = " ".join(base), " ".join(other)
        if 0.8 <= len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b)) <= 0.83:
            rows += [(len(rows), a), (len(rows) + 1, b)]
    kept_ids = {r.doc_id for r in near_dedup.drop_similar(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id").collect()}
    assert all(i in kept_ids for i in range(0, 2000, 2))
    assert sum(i not in kept_ids for i in range(1, 2000, 2)) >= 970


def test_each_row_is_decided_once(spark):
    text = "a b c d e f g h"
    rows = [(7, text), (7, text), (None, text), (7, "an other text of some more words"), (None, "k l m n o p"), (None, "k l m n o p"), (None, "q r s t u v")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.drop_similar(df)
    assert got.columns == df.columns
    assert sorted((r.doc_id or 0, r.text) for r in got.collect()) == sorted([(7, text), (7, rows[3][1]), (0, rows[4][1]), (0, rows[6][1])])
    assert near_dedup.drop_similar(df.limit(0)).count() == 0
    assert got.where(F.col("doc_id").isNull()).count() == 2


def test_fingerprints_up_to_four_bits_apart_are_found(spark):
    """The search of the pigeonring finds every pair that all pairs have."""
    rng, fps = random.Random(3), []
    for _ in range(60):
        base = rng.getrandbits(64)
        fps += [base] + [base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 7))) for _ in range(4)]
    want = {(i, j) for j in range(len(fps)) for i in range(j) if bin(fps[i] ^ fps[j]).count("1") <= 4}
    nodes = spark.createDataFrame([(i, 9, x - (1 << 64) if x >> 63 else x) for i, x in enumerate(fps)], "node long, size int, sieve long")
    assert len(want) > 100
    for n in (300, 10**6):
        assert {(r.a, r.b) for r in near_dedup._ring(nodes, n).collect()} == want


def test_a_passage_in_common_does_not_pair_its_texts_out(spark, monkeypatch):
    """Of 400 texts with the same 100 words of 170 none is near another; two pairs beside them are."""
    rng, stage = random.Random(6), near_dedup.stage
    own = lambda n: [str(rng.getrandbits(40)) for _ in range(n)]
    passage = own(100)
    texts = [passage + own(70) for _ in range(400)]
    texts += [[*texts[7][:-1], "other"], [*texts[9][:-1], "other"]]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    made = []
    monkeypatch.setattr(near_dedup, "stage", lambda d, name: made.append((name, out := stage(d, name), out.count())) or out)
    counts = []
    for crowd in (near_dedup.CROWD, 10**9):
        monkeypatch.setattr(near_dedup, "CROWD", crowd)
        assert {r.doc_id for r in near_dedup.drop_similar(df).collect()} == set(range(400))
        counts.append([n for name, _, n in made if name == "ways"][-1])
    # The fingerprint of 64 bits alone, as before, lets most rows through; buckets of two or three components have three at most.
    assert 2 * counts[0] < counts[1], counts


def test_a_key_of_many_fingerprints_loses_no_pair(spark, monkeypatch):
    """All fingerprints in one key, over the limit of those that are paired out: before, each met one other only."""
    rng = random.Random(8)
    texts = [[str(rng.getrandbits(40)) for _ in range(400)] for _ in range(40)]
    texts += [[*t[:-1], "other"] for t in texts]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    # Nothing but the fingerprints finds pairs.
    monkeypatch.setattr(near_dedup, "plan", lambda *_: ([1], 1))
    monkeypatch.setattr(near_dedup, "keys", lambda total, *_: np.frombuffer(total[:, :1].astype(np.float32).tobytes(), np.int32).reshape(-1, 1))
    monkeypatch.setattr(near_dedup, "key_masks", lambda *_: [0])
    monkeypatch.setattr(near_dedup, "PAIRED", 8)
    assert {r.doc_id for r in near_dedup.drop_similar(df).collect()} == set(range(40))


def test_parities_exclude_no_linked_pair():
    rng = np.random.default_rng(5)
    bits = lambda x, y: int(np.unpackbits((near_dedup.parities(x) ^ near_dedup.parities(y)).view(np.uint8)).sum())
    most = lambda x, y: (len(x) + len(y)) / 9
    for n in [*range(4, 40), 300, 3000]:
        x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        cut = n // 5
        other = np.unique(rng.integers(0, 1 << 63, cut // 2).astype(np.uint64))
        for y in (x[cut:], np.concatenate([x[cut // 2 + (cut - cut // 2) // 2 :], other[: cut // 4]])):
            both = len(np.intersect1d(x, y))
            if both / (len(x) + len(y) - both) >= 0.8:
                assert bits(x, y) <= most(x, y)
        assert bits(x, x) == 0
    x, y = (rng.integers(0, 1 << 63, 300).astype(np.uint64) for _ in range(2))
    y[:200] = x[:200]
    assert bits(x, y) > most(x, y)
