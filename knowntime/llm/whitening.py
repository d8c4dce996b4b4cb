"""Whitening of integer vectors by the exact characteristic polynomial of their scatter.

Vectors are made of integers, so the scatter n * sum(x x') - S S' (n squared times the
covariance) is a matrix of integers, summed exactly in Spark. Its characteristic polynomial
is computed modulo many primes, by reduction to Hessenberg form, a task a few of
them, and put together by the Chinese remainder theorem: nothing is rounded. All its roots are real, so the
number of roots above any fraction is exactly the number of sign changes of
the polynomial shifted there; bisection with whole numbers isolates the largest
ones. Inverse iteration in decimals of as many digits, at the end of such an interval, gives the
null space of the scatter less the eigenvalue: unit components to far more than double
precision. Roots that agree to ``DIGITS`` digits share a null space of their number.

Scale: equal vectors are found by one shuffle, everything else is a sum: a row's vector is
read, multiplied and forgotten. Driver and tasks see dim x dim numbers, 65 coefficients
of a few thousand bits at 64 dimensions, and ``components`` vectors.

Edge cases: vectors that are null, or hold null or non-finite entries, are left out, and so are those
whose length is not that of most vectors (the longer of equals), and empty ones. Entries past 2**63 / ``scale`` are
cut to what a long holds, and deviations that no long holds are null. Only components with an eigenvalue above zero exist:
equal vectors, one vector or an empty table give no rows. Repeated rows count once in the
fit and are each returned; null and repeated ids are ids like any other; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .staging import stage, tidy

#: Primes lie below this, so that products of two remainders and a sum fit 63 bits.
PRIMES_BELOW, PRIMES_A_TASK, DIGITS = 1 << 31, 8, 60


def integer_vectors(rows: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(id, x): floor(scale * entry) of every usable vector."""
    v = F.transform(vector_col, lambda c: c.cast("double"))
    finite = F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    made = rows.select(F.col(id_col).alias("id"), v.alias("v")).where(F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    return made.select("id", F.transform("v", lambda c: F.floor(c * scale)).alias("x"))


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def exact_products(x: np.ndarray) -> np.ndarray:
    """x' x of longs as Python integers; by doubles where no sum can pass 2**53."""
    most = int(max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))))
    rows = (1 << 53) // max(1, most * most)
    if rows == 0:
        big = x.astype(object)
        return big.T @ big
    total = np.zeros((x.shape[1], x.shape[1]), object)
    for a in range(0, len(x), min(rows, 1 << 20)):
        part = x[a : a + min(rows, 1 << 20)].astype(np.float64)
        total += (part.T @ part).astype(np.int64)
    return total


def _moments(batches):
    """Of a task's vectors: their number, sums and products, as decimal strings."""
    n, sums, products = 0, 0, 0
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch.column(0))
            n, sums, products = n + len(x), sums + x.astype(object).sum(axis=0), products + exact_products(x)
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([[str(v) for v in sums]]), pa.array([[str(v) for v in products.ravel()]])], ["n", "sums", "products"])


def _added(batches):
    out: list = [0, 0, 0]
    for batch in batches:
        for r in batch.to_pylist():
            out = [out[0] + r["n"], out[1] + np.array([int(v) for v in r["sums"]], object), out[2] + np.array([int(v) for v in r["products"]], object)]
    if out[0]:
        yield pa.RecordBatch.from_arrays([pa.array([out[0]]), pa.array([[str(v) for v in out[1]]]), pa.array([[str(v) for v in out[2]]])], ["n", "sums", "products"])


def scatter(fit: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """(n, sums, n * sum(x x') - S S') of the vectors ``x``; partial sums are added up in two rounds, by 16 tasks and by one."""
    kind = "n long, sums array<string>, products array<string>"
    parts = fit.select("x").mapInArrow(_moments, kind)
    parts = parts.repartition(16).mapInArrow(_added, kind).repartition(1).mapInArrow(_added, kind).collect()
    if not parts:
        return 0, [], []
    n, sums = parts[0].n, [int(v) for v in parts[0].sums]
    products = np.array([int(v) for v in parts[0].products], object).reshape(len(sums), -1)
    s = np.array(sums, object)
    return n, sums, (n * products - np.outer(s, s)).tolist()


def primes(number: int, below: int = PRIMES_BELOW) -> list[int]:
    """The largest primes below a bound, falling."""
    small = [p for p in range(2, 1 << 16) if all(p % q for q in range(2, int(p**0.5) + 1))]
    small, out, top = np.array([p for p in small if p * p <= below]), [], below
    while len(out) < number:
        low = max(2, top - (1 << 16))
        sieve = np.ones(top - low, bool)
        for p in small:
            sieve[max(p * p, -(-low // p) * p) - low :: p] = False
        out += (low + np.flatnonzero(sieve)[::-1]).tolist()
        top = low
    return out[:number]


def characteristic(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients of det(t - matrix) modulo the prime ``p``, constant first: by Hessenberg reduction."""
    a = np.array([[v % p for v in row] for row in matrix], np.int64)
    d = len(a)
    for j in range(d - 2):
        rest = np.flatnonzero(a[j + 1 :, j])
        if not len(rest):
            continue
        i = j + 1 + rest[0]
        if i != j + 1:
            a[[i, j + 1]] = a[[j + 1, i]]
            a[:, [i, j + 1]] = a[:, [j + 1, i]]
        factor = a[j + 2 :, j] * pow(int(a[j + 1, j]), -1, p) % p
        a[j + 2 :] = (a[j + 2 :] - factor[:, None] * a[j + 1] % p) % p
        # The same change of basis from the other side; every product is reduced before it is added.
        a[:, j + 1] = (a[:, j + 1] + (a[:, j + 2 :] * factor % p).sum(axis=1)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for m in range(1, d + 1):
        row = np.zeros(d + 1, np.int64)
        row[1:] = polys[m - 1, :-1]
        row = (row - a[m - 1, m - 1] * polys[m - 1]) % p
        below = 1
        for i in range(m - 1, 0, -1):
            below = below * int(a[i, i - 1]) % p
            if not below:
                break
            row = (row - int(a[i - 1, m - 1]) * below % p * polys[i - 1]) % p
        polys[m] = row
    return polys[d].tolist()


def polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """The characteristic polynomial of an integer matrix with real roots of zero and above, constant first."""
    # The k-th coefficient is a sum of products of k roots, at most (1 + largest root) ** d; their mean bounds the product of all 1 + root.
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    bound = 2 * (1 + -(-trace // d)) ** d
    chosen = primes(bound.bit_length() // (PRIMES_BELOW.bit_length() - 2) + 1)
    shared = spark.sparkContext.broadcast(matrix)

    def run(batches):
        for batch in batches:
            for p in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([characteristic(shared.value, p)])], ["p", "c"])

    listed = spark.createDataFrame([(p,) for p in chosen], "p long").repartition(-(-len(chosen) // PRIMES_A_TASK))
    found = {r.p: r.c for r in listed.mapInArrow(run, "p long, c array<long>").collect()}
    modulus, out = 1, [0] * (d + 1)
    for p in chosen:
        inverse = pow(modulus, -1, p)
        out = [v + modulus * ((c - v) * inverse % p) for v, c in zip(out, found[p])]
        modulus *= p
    return [v - modulus if 2 * v > modulus else v for v in out]


def roots_above(poly: list[int], number: int, power: int) -> int:
    """How many roots, with their multiplicities, lie above number / 2**power: sign changes of the polynomial shifted there."""
    d = len(poly) - 1
    c = [v << (power * (d - i)) for i, v in enumerate(poly)]
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            c[j] += number * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def largest_roots(poly: list[int], number: int, bits: int) -> list[tuple[int, int, int]]:
    """(multiplicity, low, power) of the largest roots above zero, falling: all in (low, low + 1] / 2**power, to ``bits`` binary digits.

    As many as together have at least ``number`` roots. Roots in one interval agree to these digits.
    """
    d = len(poly) - 1
    count = roots_above(poly, 0, 0)
    top = max(1, -poly[d - 1]).bit_length()
    found: list[tuple[int, int, int]] = []
    # (low, high, power, roots above high, roots above low), the upper halves first.
    open_ = [(0, 1 << top, 0, 0, count)]
    while open_ and sum(m for m, _, _ in found) < min(number, count):
        low, high, power, above, all_ = open_.pop()
        if high - low == 1 and low.bit_length() > bits:
            found.append((all_ - above, low, power))
            continue
        if high - low == 1:
            low, high, power = 2 * low, 2 * high, power + 1
        middle = (low + high) // 2
        inside = roots_above(poly, middle, power)
        if inside < all_:
            open_.append((low, middle, power, inside, all_))
        if above < inside:
            open_.append((middle, high, power, above, inside))
    return found


def null_space(matrix: list[list[int]], eigenvalue: Decimal, size: int, seed: int = 5) -> list[list[Decimal]]:
    """An orthonormal basis of ``size`` vectors of what matrix - eigenvalue takes to almost zero: inverse iteration in the decimals of the context."""
    d = len(matrix)
    a = np.array([[Decimal(v) for v in row] for row in matrix], object)
    a[np.arange(d), np.arange(d)] -= eigenvalue
    order = np.arange(d)
    for j in range(d):
        i = j + max(range(d - j), key=lambda r: abs(a[j + r, j]))
        if i != j:
            a[[i, j]], order[[i, j]] = a[[j, i]], order[[j, i]]
        if a[j, j] == 0:
            # The eigenvalue itself, to the last digit: any tiny pivot will do.
            a[j, j] = Decimal(1).scaleb(-3 * DIGITS)
        a[j + 1 :, j] /= a[j, j]
        a[j + 1 :, j + 1 :] -= np.outer(a[j + 1 :, j], a[j, j + 1 :])
    drawn = np.random.default_rng(seed).integers(-(1 << 30), 1 << 30, (size, d))
    basis = [np.array([Decimal(int(v)) for v in row], object) for row in drawn]
    for _ in range(3):
        solved = []
        for b in basis:
            x = b[order].copy()
            for j in range(d):
                x[j + 1 :] -= a[j + 1 :, j] * x[j]
            for j in range(d - 1, -1, -1):
                x[j] /= a[j, j]
                x[:j] -= a[:j, j] * x[j]
            x = x / max(abs(v) for v in x)
            for _ in range(2):
                for s in solved:
                    x = x - (x @ s) * s
            solved.append(x / (x @ x).sqrt())
        basis = solved
    return [list(b) for b in basis]


@dataclass
class Fit:
    n: int
    sums: list[int]
    #: Each component's entries, its eigenvalue of the covariance and the share of the trace.
    vectors: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray


def fitted(spark: SparkSession, n: int, sums: list[int], matrix: list[list[int]], components: int) -> Fit:
    trace = sum(matrix[i][i] for i in range(len(matrix)))
    if not trace:
        return Fit(n, sums, np.zeros((0, len(sums))), np.zeros(0), np.zeros(0))
    vectors, values = [], []
    with localcontext() as context:
        context.prec = 3 * DIGITS
        # Bits for DIGITS decimal ones.
        for size, low, power in largest_roots(polynomial(spark, matrix), components, DIGITS * 10 // 3):
            value = Decimal(2 * low + 1) / (Decimal(2) ** (power + 1))
            vectors += null_space(matrix, value, size)
            values += [value] * size
        vectors, values = vectors[:components], values[:components]
        shares = [float(v / trace) for v in values]
        values = [float(v / (n * n)) for v in values]
    return Fit(n, sums, np.array(vectors, dtype=float), np.array(values), np.array(shares))


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S: as longs where they fit, else as Python integers."""
    most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * n + max(map(abs, sums), default=0)
    if most < 1 << 62:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def whitened(x: np.ndarray, fit: Fit) -> np.ndarray:
    return centred(x, fit.n, fit.sums).astype(np.float64) @ (fit.vectors / (fit.n * np.sqrt(fit.eigenvalues))[:, None]).T


def _deviations(x: np.ndarray, fit: Fit) -> np.ndarray:
    """Sums of squares of n * x - S, exact."""
    c = centred(x, fit.n, fit.sums)
    most = max(abs(int(c.max(initial=0))), abs(int(c.min(initial=0))))
    if most * most * c.shape[1] >= 1 << 63:
        c = c.astype(object)
    return (c * c).sum(axis=1)


def _identity_error(fit_rows: DataFrame, shared, k: int) -> float:
    """The largest entry of |covariance - identity| of the whitened fit list, centred on its own mean first."""

    def means(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([whitened(_matrix(batch.column(0)), shared.value).sum(axis=0).tolist()])], ["v"])

    total = fit_rows.select("x").mapInArrow(means, "v array<double>")
    added = total.agg(*[F.sum(F.get("v", F.lit(i))) for i in range(k)]).first()
    mean = np.array(added) / shared.value.n

    def squares(batches):
        for batch in batches:
            if batch.num_rows:
                w = whitened(_matrix(batch.column(0)), shared.value) - mean
                yield pa.RecordBatch.from_arrays([pa.array([(w.T @ w).ravel().tolist()])], ["v"])

    total = fit_rows.select("x").mapInArrow(squares, "v array<double>")
    added = total.agg(*[F.sum(F.get("v", F.lit(i))) for i in range(k * k)]).first()
    return float(np.abs(np.array(added).reshape(k, k) / shared.value.n - np.eye(k)).max())


@tidy
def whiten(spark: SparkSession, rows: DataFrame, components: int = 4, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, n, deviation, whitened, explained, identity_error): the last two arrays have an entry a component, by falling eigenvalue."""
    kind = rows.schema[id_col].dataType.simpleString()
    made = integer_vectors(rows, scale, id_col, vector_col)
    lengths = made.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.orderBy(F.col("n").desc(), F.col("dim").desc()).first()
    names = f"id {kind}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    if usual is None:
        return spark.createDataFrame([], names).withColumnRenamed("id", id_col)
    made = made.where(F.size("x") == usual.dim)
    fit_rows = stage(made.select("x").distinct(), "fit")
    fit = fitted(spark, *scatter(fit_rows), components)
    k = len(fit.eigenvalues)
    shared = spark.sparkContext.broadcast(fit)
    error = _identity_error(fit_rows, shared, k) if k else None

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                x, size = _matrix(part.column(1)), part.num_rows
                deviation = pa.array([v if v < 1 << 63 else None for v in _deviations(x, shared.value).tolist()], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.full(size, shared.value.n)), deviation, pa.array(whitened(x, shared.value).tolist(), pa.list_(pa.float64())),
                     pa.array([shared.value.explained.tolist()] * size, pa.list_(pa.float64())), pa.array([error] * size, pa.float64())],
                    ["id", "n", "deviation", "whitened", "explained", "identity_error"])

    return made.mapInArrow(run, names).withColumnRenamed("id", id_col)
