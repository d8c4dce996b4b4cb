"""SimHash near-dedup with pigeonring filtering.

A fingerprint bit is set if it is set in over half of the hashes of a text's
word shingles (XXH64, seed 42, repeats included). Two fingerprints link at up to
``distance`` differing bits. Copies of a fingerprint are one node.

The 64 bits are cut into m segments on a ring, m > distance. Two linked fingerprints
agree in m - distance segments at least, and have a start from which every chain of l
consecutive segments differs in at most l * distance / m bits (the pigeonring
principle). So a fingerprint is written once for each choice of m - distance
segments, with their bits as key; pairs that meet at a key are pruned by the budgets of
the chains, then checked by the full distance. m is as large as is needed for
keys of about log2(n) bits, which changes the cost, not the links.

Scale: at distance 4 a fingerprint has 5 rows up to 2**14 fingerprints, 15 up to 2**23,
35 up to 2**29, 70 up to 2**34 (1.7e10). A key that over ``crowd`` fingerprints
share is not paired out: its members each write
the points within half the distance and are linked through the smallest
fingerprint at a point: a fixed number of rows each and the same components.

Edge cases: a text of fewer words than a shingle is one shingle; a null text or
one without words has fingerprint zero and links like any other. Repeated rows
are repeated in the result. A null id is returned with its fingerprint and
never names a component that has another id.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .skew import attach
from .staging import numbered, stage, tidy
from .vectortext import mix, slabs

BITS = 64
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: bytes, shingle: int, tables: int = 1) -> list[int]:
    """The 64 bits as a signed integer, once a table; tables past the first use remixed hashes."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return [0] * tables
    size = min(shingle, len(words))
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    one = xxhash.xxh64_intdigest
    hashes = np.array([one(line[i:j], 42) for i, j in zip(starts[: len(words) - size + 1].tolist(), (ends[size - 1 :] - 1).tolist())], np.uint64)
    out = []
    for t in range(tables):
        own = hashes if t == 0 else mix(hashes + np.uint64(t))
        byte = own.astype(">u8").view(np.uint8).reshape(-1, 8) + np.arange(0, 2048, 256)
        counts = np.bincount(byte.ravel(), minlength=2048).reshape(8, 256) @ _BYTE_BITS
        out.append(int.from_bytes(np.packbits(counts.ravel() * 2 > len(own)).tobytes(), "big", signed=True))
    return out


def _fingerprints(shingle: int, tables: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for a, b, texts in slabs(batch.column(1)):
                made = [fingerprint(t, shingle, tables) for t in texts]
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.array(made, pa.list_(pa.int64()))], ["id", "fps"])

    return run


def fingerprints(docs: DataFrame, shingle: int, tables: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fps) of every row; fps has one fingerprint a table."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_fingerprints(shingle, tables), "id long, fps array<long>")


def _signed(x: int) -> int:
    x &= (1 << BITS) - 1
    return x - (1 << BITS) if x >> (BITS - 1) else x


def segments(m: int) -> list[list[int]]:
    """The bit numbers of each of m segments."""
    cuts = [BITS * i // m for i in range(m + 1)]
    return [list(range(a, b)) for a, b in zip(cuts, cuts[1:])]


def cuts(distance: int, n: int) -> int:
    """Segments: the fewest whose keys have about log2(n) bits."""
    m = distance + 1
    while BITS * (m - distance) // m < n.bit_length() - 2 and m < 16:
        m += 1
    return m


def key_masks(m: int, distance: int) -> list[int]:
    """The bits of every choice of m - distance segments."""
    parts = segments(m)
    return [_signed(sum(1 << b for i in chosen for b in parts[i])) for chosen in combinations(range(m), m - distance)]


def within_budgets(differ: Column, m: int, distance: int) -> Column:
    """Some start has all its chains within l * distance / m differing bits."""
    parts, fits = segments(m), F.lit(False)
    for start in range(m):
        mask, chain = 0, F.lit(True)
        for i in range(m):
            mask |= sum(1 << b for b in parts[(start + i) % m])
            chain = chain & (F.bit_count(differ.bitwiseAND(F.lit(_signed(mask)))) <= (i + 1) * distance // m)
        fits = fits | chain
    return fits


def links(nodes: DataFrame, distance: int, n: int, crowd: int = 4096) -> DataFrame:
    """(a, b): linked pairs of the distinct fingerprints ``fp``, enough for their components."""
    m = cuts(distance, n)
    masks = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(x).alias("mask")) for i, x in enumerate(key_masks(m, distance))])
    index = nodes.select("fp", F.explode(masks).alias("cut"))
    index = index.select("fp", F.struct(F.col("cut.i").alias("i"), F.col("fp").bitwiseAND(F.col("cut.mask")).alias("k")).alias("key"))
    crowded = stage(index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowd).select("key"), "crowded")
    has_crowds, full = not crowded.isEmpty(), index
    if has_crowds:
        index = index.join(crowded, "key", "left_anti")
    a, b = index.select(F.col("fp").alias("a"), "key"), index.select(F.col("fp").alias("b"), "key")
    differ = F.col("a").bitwiseXOR(F.col("b"))
    near = a.join(b, "key").where((F.col("a") < F.col("b")) & (F.bit_count(differ) <= distance) & within_budgets(differ, m, distance))
    edges = near.select("a", "b")
    if has_crowds:
        edges = edges.unionByName(_through_points(full.join(crowded, "key", "left_semi").select("fp").distinct(), distance))
    return edges.distinct()


def _through_points(members: DataFrame, distance: int) -> DataFrame:
    """Stars around shared points: equal components without all pairs.

    Points within ``distance // 2`` bits of a member meet those within
    ``distance - distance // 2`` bits of another exactly if the two link.
    """
    near, far = distance // 2, distance - distance // 2
    ring = members.select("fp", F.col("fp").alias("point"), F.lit(-1).alias("last"))
    points = ring.select("fp", "point", F.lit(True).alias("inner"))
    for flipped in range(1, far + 1):
        ring = ring.where(F.col("last") < BITS - 1).select("fp", "point", F.explode(F.sequence(F.col("last") + 1, F.lit(BITS - 1))).alias("last"))
        ring = ring.select("fp", F.col("point").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("last"))).alias("point"), "last")
        points = points.unionByName(ring.select("fp", "point", F.lit(flipped <= near).alias("inner")))
    low = points.where("inner").groupBy("point").agg(F.min("fp").alias("low"))
    return stage(points, "points").join(stage(low, "lows"), "point").where("fp <> low").select(F.col("fp").alias("a"), F.col("low").alias("b"))


def _edges(nodes: DataFrame, table: int, distance: int, n: int, crowd: int) -> DataFrame:
    """(a, b): linked nodes by one table; a fingerprint that several nodes share has one of them for all."""
    of = nodes.select(F.get("fps", F.lit(table)).alias("fp"), "fps")
    heads = stage(of.groupBy("fp").agg(F.min("fps").alias("head")), "heads")
    near = stage(links(heads.select("fp"), distance, n, crowd), "links")
    left, right = heads.select(F.col("fp").alias("a"), F.col("head").alias("ha")), heads.select(F.col("fp").alias("b"), F.col("head").alias("hb"))
    between = near.join(left, "a").join(right, "b").select(F.col("ha").alias("a"), F.col("hb").alias("b"))
    shared = of.join(heads, "fp").where("fps <> head").select(F.col("fps").alias("a"), F.col("head").alias("b"))
    return between.unionByName(shared)


@tidy
def near_groups(docs: DataFrame, shingle: int = 5, distance: int = 4, tables: int = 1, id_col: str = "doc_id", text_col: str = "text", crowd: int = 4096) -> DataFrame:
    """(id, fps, component_id) of every row; component_id is the smallest id it reaches.

    With several ``tables`` rows link if any of their fingerprints do, which
    finds more of the pairs whose similarity is near the limit.
    """
    rows = stage(fingerprints(docs, shingle, tables, id_col, text_col), "fingerprints")
    nodes = stage(rows.groupBy("fps").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n")), "nodes")
    total, distinct = rows.count(), nodes.count()
    edges = _edges(nodes, 0, distance, distinct, crowd)
    for t in range(1, tables):
        edges = edges.unionByName(_edges(nodes, t, distance, distinct, crowd))
    label = components(edges)
    of = nodes.join(label.select(F.col("a").alias("fps"), F.col("component").alias("root")), "fps", "left").select("fps", "n", "low", F.coalesce("root", "fps").alias("root"))
    of = stage(of, "labelled")
    sizes = of.groupBy("root").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("members"))
    named = attach(of, stage(sizes, "roots"), "root", "members", distinct)
    out = attach(rows, stage(named.select("fps", "n", "component_id"), "named"), "fps", "n", total)
    return out.select(F.col("id").alias(id_col), "fps", F.coalesce("component_id", "id").alias("component_id"))


@tidy
def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each group stays, the one with the smallest id, a null id last, of equal ids the first; all columns are kept."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = numbered(docs.toDF(*names), "row")
    found = near_groups(plain, id_col="row", text_col=names[docs.columns.index(text_col)], **options).select("row", F.col("component_id").alias("component"))
    found = stage(found.join(plain.select("row", F.col(names[docs.columns.index(id_col)]).alias("id")), "row"), "found")
    heads = found.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    gone = attach(found, stage(heads, "heads"), "component", "n", found.count()).where("row <> head.row").select("row")
    return plain.join(stage(gone, "gone"), "row", "left_anti").select(*names).toDF(*docs.columns)
