import random

import pytest
import xxhash
from pyspark.sql import functions as F

from knowntime.llm import simhash


def brute(texts, shingle, distance):
    prints = []
    for t in texts:
        w = (t or "").encode().lower().split()
        h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + shingle]), 42) for i in range(max(1, len(w) - shingle + 1))] if w else []
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    low = list(range(len(texts)))
    moved = True
    while moved:
        moved = False
        for i in range(len(texts)):
            for j in range(len(texts)):
                if (prints[i] ^ prints[j]).bit_count() <= distance and low[j] < low[i]:
                    low[i], moved = low[j], True
    return prints, low


def corpus():
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(200)]
    texts = [" ".join(rng.choices(vocab, k=rng.randint(1, 120))) for _ in range(60)]
    for t in texts[:20]:
        w = t.split()
        for _ in range(2):
            w[rng.randrange(len(w))] = rng.choice(vocab)
            texts.append(" ".join(w).upper())
    return [*texts, None, "", "  \n", "one", "One", texts[5], "é É ñ ü x"]


@pytest.mark.parametrize("crowd", [4096, 2])
def test_components_are_those_of_all_pairs(spark, crowd):
    texts = corpus()
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, fp string")
    prints, low = brute(texts, 4, 4)
    got = {r.doc_id: (r.fps[0] & (1 << 64) - 1, r.component_id) for r in simhash.near_groups(df, 4, 4, crowd=crowd).collect()}
    assert got == {i: (p, c) for i, (p, c) in enumerate(zip(prints, low))}
    assert len(set(low)) < len(low) - 5


def test_links_of_random_prints(spark):
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(40)]
    prints = sorted({simhash._signed(c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5)))) for c in centres for _ in range(12)})
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    for distance in (1, 3, 4, 6):
        want = {(a, b) for a in prints for b in prints if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= distance}
        got = {(r.a, r.b) for r in simhash.links(df, distance, len(prints)).collect()}
        assert got == want


def test_empty_and_repeated(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_groups(empty).count() == 0
    same = spark.createDataFrame([(7, "a b c d e f"), (7, "a b c d e f"), (9, "a b c d e f"), (None, "zz yy")], "doc_id long, text string")
    assert sorted((r.doc_id is None, r.component_id is None, r.component_id or 0) for r in simhash.near_groups(same).collect()) == [(False, False, 7)] * 3 + [(True, True, 0)]
    assert [(r.doc_id, r.text) for r in simhash.drop_near_duplicates(same).orderBy(F.col("doc_id").desc_nulls_last()).collect()] == [(7, "a b c d e f"), (None, "zz yy")]


def test_rows_that_share_an_id_are_rows_of_their_own(spark):
    rows = [(1, "a b c d e f", "x"), (5, "a b c d e f", "y"), (5, "nothing like the other one at all", "z"), (None, "a b c d e f", "w"), (None, "some more words of another kind", "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _gone string")
    got = simhash.drop_near_duplicates(df)
    assert got.columns == df.columns and sorted(r._gone for r in got.collect()) == ["v", "x", "z"]


def test_rows_a_fingerprint_stay_few():
    import math

    for n, most in ((10**4, 15), (10**6, 15), (10**8, 35), (10**10, 70)):
        assert math.comb(simhash.cuts(4, n), 4) <= most


def test_more_tables_only_add_links(spark):
    texts = corpus()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    one = {r.doc_id: r.component_id for r in simhash.near_groups(df, 5, 6).collect()}
    more = {r.doc_id: r.component_id for r in simhash.near_groups(df, 5, 6, tables=3).collect()}
    assert all(more[i] <= one[i] for i in one) and len(set(more.values())) < len(set(one.values()))
