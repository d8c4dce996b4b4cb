import random

import numpy as np
from knowntime.llm import mixing


def targets_by_hand(sizes, weights, total, most):
    open_, out, left = set(sizes), {}, total
    while True:
        w = sum(weights[s] for s in open_)
        over = {s for s in open_ if left * weights[s] / w > most * sizes[s] + 1e-9}
        if not over:
            return out | {s: left * weights[s] / w for s in open_}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
            open_.discard(s)


def docs(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.choice([0, 1, 5, 30, 200]), "big" if i % 3 else f"s{i % 8}", "x") for i in range(900)]
    rows += [(900, None, None, "x"), (901, "a b\tc\x0bd", None, "x"), (902, "", "none", "x"), (903, "x y", "s0", "x"), (903, "x y", "s0", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string"), rows


def test_targets_and_balance(spark):
    df, rows = docs(spark)
    out = mixing.mix_sources(df, block=50).join(df.select("doc_id", "source").distinct(), "doc_id").collect()
    sizes = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    names = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: [3.0, 1.0, 2.0][i % 3] for i, s in enumerate(names)}
    want = targets_by_hand({s: v for s, v in sizes.items() if v}, weights, 1.5 * sum(sizes.values()), 2.0)
    assert len(out) == len(rows)
    for s in names:
        mine = [r for r in out if r.source == s]
        assert all(r.source_size == sizes[s] and abs(r.target - want.get(s, 0.0)) < 1e-6 for r in mine)
        assert all(r.taken <= 2 * r.size for r in mine)
        assert abs(sum(r.taken for r in mine) - want.get(s, 0.0)) <= max([r.size for r in mine], default=0)
    again = {(r.doc_id, r.taken) for r in mixing.mix_sources(df.repartition(7), block=50).collect()}
    assert again == {(r.doc_id, r.taken) for r in out}


def test_targets_of_many_sources(spark):
    rng = random.Random(9)
    for share in (0.3, 1.0, 1.5, 1.99):
        sizes = {f"s{i:02d}": rng.choice([1, 5, 50, 400, 3000]) for i in range(25)}
        rows = [(s, n) for s, n in sizes.items()]
        weights = {s: [3.0, 1.0, 2.0][i % 3] for i, s in enumerate(sorted(sizes))}
        want = targets_by_hand(sizes, weights, share * sum(sizes.values()), 2.0)
        got = mixing.source_targets(spark.createDataFrame(rows, "source string, size long"), [3.0, 1.0, 2.0], share, 2.0)
        got = {r.source: r.target for r in got.collect()}
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)
        assert abs(sum(got.values()) - share * sum(sizes.values())) < 1e-6


def test_flight_keeps_totals():
    rng = np.random.default_rng(2)
    x = [int(v) for v in rng.integers(1, 500, 300)]
    p = np.full(300, 0.37)
    q = mixing.flight(p, x, rng)
    assert ((q > 0) & (q < 1)).sum() <= 2
    assert abs(q.sum() - p.sum()) < 1e-6 and abs((q * x).sum() - (p * x).sum()) < 1e-4


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix_sources(empty).count() == 0


def test_mixed(spark):
    rows = [(7, "one two three", "a", "p"), (7, "four five", "a", "q"), (None, "six", "b", "r"), (None, "seven eight", "b", "s"), (1, None, "a", "t"), (2, "w " * 50_000, "a", "u")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copies string")
    got = mixing.mixed(df)
    assert got.columns == df.columns
    times = {k: sum(r.copies == k for r in got.collect()) for k in "pqrstu"}
    assert all(n <= 2 for n in times.values()) and times["t"] == 0
    taken = sum(times[k] * len((t or "").split()) for _, t, _, k in rows)
    assert abs(taken - 1.5 * 50_008) <= 50_000
    assert mixing.mixed(df.limit(0)).count() == 0
