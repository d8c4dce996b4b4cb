import random
from decimal import localcontext
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from knowntime.llm import q_op13, whitening


def leverrier(m):
    """Characteristic polynomial by traces of powers, in fractions; constant first."""
    d = len(m)
    m = [[Fraction(v) for v in row] for row in m]
    c, b = [Fraction(1)], [[Fraction(int(i == j)) for j in range(d)] for i in range(d)]
    for k in range(1, d + 1):
        ab = [[sum(m[i][x] * b[x][j] for x in range(d)) for j in range(d)] for i in range(d)]
        c.append(-sum(ab[i][i] for i in range(d)) / k)
        b = [[ab[i][j] + (c[-1] if i == j else 0) for j in range(d)] for i in range(d)]
    return [int(v) for v in reversed(c)]


def gram(rng, d, rank, size):
    x = np.array([[rng.randint(-size, size) for _ in range(d)] for _ in range(rank)], object)
    return (x.T @ x).tolist()


def test_characteristic_polynomial(spark):
    rng = random.Random(1)
    for d, rank, size in ((1, 1, 5), (2, 1, 9), (5, 5, 1000), (6, 3, 10**9), (7, 7, 2), (9, 9, 10**6)):
        m = gram(rng, d, rank, size)
        assert whitening.polynomial(spark, m) == leverrier(m)
    # Any integer matrix, with zeros where a pivot is looked for.
    m = [[0, 0, 3, 1], [0, 2, 0, 0], [5, 0, 0, 7], [0, 4, 0, 1]]
    p = whitening.primes(3)
    assert p == [2147483647, 2147483629, 2147483587]
    for q in p:
        assert [v % q for v in whitening.characteristic(m, q)] == [v % q for v in leverrier(m)]


def test_roots_and_their_multiplicities():
    poly = np.array([1], object)
    for root in (0, 0, 3, 7, 7, 7, 1000, 1001):
        poly = np.convolve(poly, np.array([1, -root], object))
    poly = [int(v) for v in poly[::-1]]
    assert [whitening.roots_above(poly, a, 0) for a in (0, 3, 6, 7, 1000, 1001)] == [6, 5, 5, 2, 1, 0]
    assert whitening.roots_above(poly, 2001, 1) == 1
    found = whitening.largest_roots(poly, 4, 40)
    assert [m for m, _, _ in found] == [1, 1, 3]
    for (_, low, power), root in zip(found, (1001, 1000, 7)):
        assert low < root << power <= low + 1 and low.bit_length() > 40
    assert sum(m for m, _, _ in whitening.largest_roots(poly, 99, 30)) == 6


def test_components_of_near_and_equal_eigenvalues():
    """Eigenvalues that differ in the 16th digit only, where doubles would mix their vectors, and one met three times."""
    q = np.array([[2, 1, 2, 0], [-2, 2, 1, 0], [1, 2, -2, 0], [0, 0, 0, 3]], object)
    big = 10**17
    m = (q.T @ np.diag(np.array([big, big + 1, 5, 7], object)) @ q).tolist()
    with localcontext() as c:
        c.prec = 180
        poly = leverrier(m)
        for (size, low, power), row in zip(whitening.largest_roots(poly, 2, 200), (1, 0)):
            assert size == 1
            v = whitening.null_space(m, c.create_decimal(2 * low + 1) / c.create_decimal(2) ** (power + 1), 1)[0]
            assert abs(abs(sum(a * int(b) for a, b in zip(v, q[row]))) / 3 - 1) < 1e-40
        basis = np.array(whitening.null_space(np.diag([9, 9, 4, 9]).tolist(), c.create_decimal(9) + c.create_decimal(10) ** -60, 3), float)
    assert np.allclose(basis @ basis.T, np.eye(3), atol=1e-14) and np.allclose(basis[:, 2], 0, atol=1e-14)


def expected(x, k):
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(0)
    c = u - s / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1], v[:, ::-1]
    return n, ((n * x - s) ** 2).sum(1), (x - s / n) @ v[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def same(got, want):
    return np.allclose(got, want, atol=1e-9) or np.allclose(got, -want, atol=1e-9)


def test_rows(spark):
    """Nulls in and of vectors, infinities, other lengths, repeated rows, null ids, clashing columns."""
    rng = np.random.default_rng(4)
    v = rng.normal(size=(60, 6)) * [5, 3, 2, 1, 0.5, 0.1]
    v[10:20] = v[0]
    rows = [(None if i == 3 else i, x.tolist()) for i, x in enumerate(v)] + [(5, v[5].tolist()), (5, v[7].tolist())]
    bad = [(90, None), (91, []), (92, [None] * 6), (93, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (94, [float("nan")] * 6), (95, [1.0] * 5 + [float("-inf")]), (96, [1.0, 2.0])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").withColumns({c: F.lit("own") for c in ("id", "x", "n", "v", "deviation")})
    out = whitening.whiten(spark, df)
    assert out.columns == ["vec_id", "n", "deviation", "whitened", "explained", "identity_error"]
    got = sorted(out.collect(), key=lambda r: (str(r.vec_id), r.deviation))
    rows.sort(key=lambda r: str(r[0]))
    x = np.floor(256 * np.array([r[1] for r in rows])).astype(np.int64)
    n, deviation, w, explained = expected(x, 4)
    order = sorted(range(len(rows)), key=lambda i: (str(rows[i][0]), deviation[i]))
    assert [(r.vec_id, r.n, r.deviation) for r in got] == [(rows[i][0], n, deviation[i]) for i in order]
    for k in range(4):
        assert same(np.array([r.whitened[k] for r in got]), w[order, k])
        assert abs(got[0].explained[k] - explained[k]) < 1e-12
    assert got[0].identity_error < 1e-9
    # As many components as there are eigenvalues above zero.
    flat = whitening.whiten(spark, spark.createDataFrame([(i, [float(i), 2.0 * i, 7.0]) for i in range(5)], df.schema[:2]))
    assert {len(r.whitened) for r in flat.collect()} == {1}
    for few in (df.limit(0), df.where("vec_id = 0"), df.where("vec_id in (0, 10, 11)"), df.where("vec_id > 89 and vec_id < 96")):
        assert all(r.whitened == [] and r.deviation == 0 for r in whitening.whiten(spark, few).collect())


def test_large_and_uncut_numbers(spark):
    rows = [(i, [float(a), float(b)]) for i, (a, b) in enumerate([(1 << 40, 3), (-(1 << 40), 5), (7, 1 << 41), (1e300, 0), (0.00390625, -0.0)])]
    found = whitening.whiten(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 2).collect()
    assert len(found) == 5 and all(len(r.whitened) == 2 and r.deviation is None for r in found)
    assert found[0].identity_error < 1e-4
    x = np.array([[1 << 62, -(1 << 62)], [3, 1]])
    assert whitening.exact_products(x).tolist() == [[(1 << 124) + 9, -(1 << 124) + 3], [-(1 << 124) + 3, (1 << 124) + 1]]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = {(r.vec_id, r.component): r for r in q_op13.query(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    x = np.floor(256 * np.array([r.embedding for r in rows])).astype(np.int64)
    n, deviation, w, explained = expected(x, 4)
    assert len(got) == 4 * len(rows)
    for k in range(4):
        mine = [got[r.vec_id, k + 1] for r in rows]
        assert same(np.array([r.whitened for r in mine]), w[:, k])
        assert [(r.n, r.deviation) for r in mine] == [(n, d) for d in deviation]
        assert all(abs(r.explained - explained[k]) < 1e-12 and r.identity_error < 1e-4 for r in mine)
