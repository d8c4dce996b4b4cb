"""Whole batches of text as numpy arrays: words, rolling hashes, per-document ranges.

Used inside Arrow tasks. Words are runs of bytes other than space and \\x09-\\x0D,
and hashes are 64-bit: a polynomial over the bytes by prefix sums, then mixed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Odd multipliers (golden ratio; the two constants of the splitmix64 finaliser).
BASE = 0x9E3779B97F4A7C15
MIX1, MIX2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX2)
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64, for i < n."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        made = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            made.append(np.cumprod(p))
        have = _POWERS[base] = (made[0], made[1])
    return have[0][:n], have[1][:n]


@dataclass
class Words:
    """Words of several texts: byte range, hash and document of each; ``first[d]`` to ``first[d + 1]`` are those of document d."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    doc: np.ndarray
    first: np.ndarray


def words(texts: list[bytes], separator: np.ndarray = SEPARATOR) -> Words:
    joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    begins = np.concatenate(([0], np.cumsum(sizes)))
    inside = ~separator[joined]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate(([0], edge))
    start, end = edge[::2], edge[1::2]
    pw, inverse = powers(len(joined) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((joined.astype(np.uint64) + np.uint64(1)) * pw[:-1])))
    h = mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))
    first = np.searchsorted(start, begins)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(joined, start, end, h, doc, first)


def rehash(w: Words, base: int) -> np.ndarray:
    """Hashes of the same words by a polynomial over another base, independent of ``w.hash``."""
    pw, inverse = powers(len(w.data) + 1, base)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((w.data.astype(np.uint64) + np.uint64(1)) * pw[:-1])))
    return mix((total[w.end] - total[w.start]) * inverse[w.start] + (w.end - w.start).astype(np.uint64))


def grams(h: np.ndarray, size: int) -> np.ndarray:
    """Rabin-Karp hash of every ``size`` consecutive hashes."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    pw, inverse = powers(len(h) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * pw[:-1])))
    return mix((total[size:] - total[:-size]) * inverse[:n])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` consecutive values, by doubling."""
    if len(x) < width:
        return x[:0]
    reach = 1
    while reach * 2 <= width:
        x = np.minimum(x[:-reach], x[reach:])
        reach *= 2
    return np.minimum(x[: len(x) - (width - reach)], x[width - reach :]) if width > reach else x


def slabs(column, limit: int = 1 << 20):
    """(from, to, texts as bytes) over an Arrow string column, about ``limit`` bytes at a time; null is empty."""
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right")))
        yield at, to, as_bytes(column.slice(at, to - at))
        at = to


def as_bytes(column) -> list[bytes]:
    """An Arrow string column as bytes; null is empty."""
    import pyarrow as pa

    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]
