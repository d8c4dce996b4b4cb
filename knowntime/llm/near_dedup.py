"""Near-dedup at a Jaccard similarity: SimHash finds candidates, shingle sets confirm them.

The shingle set of a text is the set of hashes of its word shingles (A-Z in lower
case). Texts of equal sets are one node. SimHash adds up, for each of 512 bits, +1 or
-1 over the hashes of the set; the sums of two sets of similarity s correlate by
2s / (1 + s). A Hadamard transform turns the sums, which keeps that and breaks the ties of
short texts. A key is made of the most decided sums: of a few drawn groups of the 512
each gives the place of its largest sum and the sign of it, which near copies share far
oftener than as many signs alone. Two nodes are candidates if one of their ``bands`` keys
agrees. The length of a key is about log2 of the number of nodes, and the number
of keys follows from it and from ``recall``. The signs of 64 further sums are a node's fingerprint:
fingerprints up to RING bits apart are candidates too, searched as :mod:`.simhash` does, by keys of agreeing
segments under the budgets of the pigeonring. Candidates link if the Jaccard similarity of their
sets is at least ``similarity``; the fingerprints and the sizes of the sets rule most
others out before; a SimHash test of a pair of candidates, like the keys, goes by chance, and ``recall`` says how near it comes to all pairs.

Scale: in each bucket all members are compared with one of them, another one in every
bucket that the same nodes share; only where a
bucket still holds several components after that are its remaining pairs
compared, of nodes in different components. A bucket of CROWD or more components, such as
texts with a passage in common or copies too far apart to link, is compared first by the parities of the numbers of hashes in 512 bins.
Sets differ in at least as many hashes as parities, so no linked pair is lost by that. A key of fingerprints with over PAIRED nodes is a
bucket like those of the sums. Where one of two components is large, its members
are dealt into blocks and every node of the other meets each block in a task, which finds
the links without a row for a pair. So a large group of near copies costs
a few rows a member, and no pair of candidates is left out. Buckets meet in a window by
key; the keys that a sketch of frequent items names are aggregated and broadcast instead.
Keys a node: 69 at 2 * 10**5 nodes, 147 at 10**7, 538 at 10**10.

Edge cases: a text of fewer words than a shingle is one shingle; texts without
words are copies of each other. Every row is decided on its own, by a row number
written with the table: repeated rows and rows with a null id are rows like any
other. Of a group the row with the smallest id stays, a null id last.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .simhash import cuts, key_masks, within_budgets
from .skew import attach
from .staging import drop, numbered, stage, stage_at, tidy
from .vectortext import grams, mix, slabs, words

#: Words of 64 bits whose sums keys are drawn from; one more is the sieve.
DRAWN = 8
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float32)
_SALT = np.arange(1, DRAWN + 2, dtype=np.uint64)
_PLACE = np.arange(0, 256 * 8 * (DRAWN + 1), 256)
_FLIP = np.where(np.random.default_rng(7).random(DRAWN * 64) < 0.5, np.float32(-1), np.float32(1))
#: Keys that the sketch names, its counters, and the members from which on a key is aggregated apart.
FREQUENT, TRACKED, MANY = 1000, 10_000, 10_000
#: Members from which on a component is met in blocks; members of a block, nodes that meet one in a task, and bytes of either side's sets.
LARGE, BLOCK, ASKING, SIDE_BYTES = 64, 256, 1024, 16 << 20
#: Components from which on a bucket is a crowd; differing bits of fingerprints that are searched for, and nodes up to which such a key is paired out.
CROWD, RING, PAIRED = 4, 4, 4096
#: Bins of hashes whose parities tell sets of a crowd apart.
BINS = 512
_ODD = [f"odd{i}" for i in range(BINS // 64)]


def shingle_sets(texts: list[bytes], shingle: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    w = words([t.lower() for t in texts])
    own = [w.hash[a:b] for a, b in zip(w.first[:-1], w.first[1:])]
    return [np.unique(grams(h, min(shingle, len(h)))) if len(h) else np.zeros(0, np.uint64) for h in own]


def sums(hashes: np.ndarray) -> np.ndarray:
    """For each of (DRAWN + 1) * 64 bits, the hashes with it less those without it."""
    counts = np.zeros(256 * 8 * (DRAWN + 1), np.int64)
    for i in range(0, len(hashes), 4096):
        byte = mix(hashes[i : i + 4096, None] + _SALT).view(np.uint8) + _PLACE
        counts += np.bincount(byte.ravel(), minlength=len(counts))
    ones = counts.reshape(-1, 256).astype(np.float32) @ _BYTE_BITS
    return ones.ravel() * 2 - len(hashes)


def rotated(total: np.ndarray) -> np.ndarray:
    """The sums (rows by 64 * DRAWN) with random signs under a Hadamard transform."""
    x, h = total * _FLIP, 1
    while h < x.shape[1]:
        pair = x.reshape(len(x), -1, 2, h)
        x = np.stack((pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]), 2).reshape(len(x), -1)
        h *= 2
    return x


def parities(hashes: np.ndarray) -> np.ndarray:
    """For each bin, whether an odd number of the hashes is in it, as words of 64 bits."""
    counts = np.bincount((hashes % np.uint64(BINS)).astype(np.int64), minlength=BINS)
    return np.packbits((counts & 1).astype(bool)).view(np.int64)


def agreement(size: int, similarity: float, trials: int = 4000) -> float:
    """How often two texts share the place and sign of the largest of ``size`` sums."""
    drawn, rho = np.random.default_rng(3), 2 * similarity / (1 + similarity)
    x = drawn.normal(size=(trials, size))
    y = rho * x + math.sqrt(1 - rho * rho) * drawn.normal(size=x.shape)
    i, j, r = np.abs(x).argmax(1), np.abs(y).argmax(1), np.arange(trials)
    return float(((i == j) & (np.sign(x[r, i]) == np.sign(y[r, j]))).mean())


def plan(nodes: int, similarity: float, recall: float) -> tuple[list[int], int]:
    """(sizes of a key's groups of bits, number of keys); a group of 2 ** (b - 1) bits gives b bits of the key."""
    length = max(10, nodes.bit_length())
    picks = max(2, round(length / 6))
    sizes = [1 << (length // picks + (i < length % picks) - 1) for i in range(picks)]
    both = math.prod(agreement(size, similarity) for size in sizes)
    # Groups share their bits, and short texts have ties: half as many keys again as independent ones need.
    return sizes, math.ceil(1.5 * math.log(1 - recall) / math.log(1 - both))


def keys(total: np.ndarray, sizes: list[int], bands: int) -> np.ndarray:
    """The keys (rows by bands) of sums (rows by 64 * DRAWN)."""
    drawn = np.random.default_rng(11)
    strength, out = np.abs(total), np.zeros((len(total), bands), np.int32)
    row = np.arange(len(total))
    for band in range(bands):
        for size in sizes:
            group = drawn.choice(DRAWN * 64, size, replace=False)
            at = strength[:, group].argmax(1)
            out[:, band] = out[:, band] * (2 * size) + at * 2 + (total[row, group[at]] > 0)
    return out


def _signed(sets) -> pa.Array:
    return pa.array([xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63) for s in sets], pa.int64())


def _nodes(shingle: int, sizes: list[int], bands: int):
    def run(batches):
        for batch in batches:
            for a, b, texts in slabs(batch.column(1)):
                sets = shingle_sets(texts, shingle)
                total = np.stack([sums(s) for s in sets])
                sieve = np.packbits(total[:, DRAWN * 64 :] > 0, axis=1).view(np.int64).ravel()
                turned = rotated(total[:, : DRAWN * 64])
                made, odd = keys(turned, sizes, bands), np.stack([parities(s) for s in sets])
                listed = pa.ListArray.from_arrays(pa.array(np.arange(0, made.size + 1, bands), pa.int32()), pa.array(made.ravel()))
                size = pa.array([len(s) for s in sets], pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), _signed(sets), size, pa.array(sieve), listed, *map(pa.array, odd.T)], ["row", "node", "size", "sieve", "keys", *_ODD])

    return run


def _sets(shingle: int):
    def run(batches):
        for batch in batches:
            for a, b, texts in slabs(batch.column(1)):
                sets = [s.tobytes() for s in shingle_sets(texts, shingle)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(sets, pa.binary())], ["node", "shingles"])

    return run


def _confirm(similarity: float):
    def alike(x, y):
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        both = len(np.intersect1d(x, y, assume_unique=True))
        # The same quotient as a brute-force check has.
        return both / (len(x) + len(y) - both) >= similarity

    def run(batches):
        for batch in batches:
            kept = [alike(x.as_buffer(), y.as_buffer()) for x, y in zip(batch.column(2), batch.column(3))]
            yield batch.select([0, 1]).filter(pa.array(kept, pa.bool_()))

    return run


def _meet(similarity: float):
    """(a, b): for every asking set one set of the block that it links to, if there is any."""

    def run(block: pa.Table, asking: pa.Table) -> pa.Table:
        a, b = [], []
        if block.num_rows and asking.num_rows:
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in block.column("of_shingles")]
            size = np.array([len(x) for x in sets])
            hashes, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
            order = np.argsort(hashes, kind="stable")
            hashes, owner, names = hashes[order], owner[order], block.column("of_node").to_numpy()
            for node, x in zip(asking.column("by_node").to_pylist(), asking.column("by_shingles")):
                x = np.frombuffer(x.as_buffer(), np.uint64)
                low = np.searchsorted(hashes, x, "left")
                width = np.searchsorted(hashes, x, "right") - low
                ends = np.cumsum(width)
                both = np.bincount(owner[np.repeat(low - ends + width, width) + np.arange(ends[-1] if len(ends) else 0)], minlength=len(sets))
                hit = np.flatnonzero(both / (size + len(x) - both) >= similarity)
                if len(hit):
                    a.append(node)
                    b.append(int(names[hit[0]]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _in_blocks(ways: DataFrame, label: DataFrame, sizes: DataFrame, sets_of, similarity: float) -> DataFrame:
    """Links (a, b) between components of ``ways`` (asking, target), found by blocks of each target's members.

    ``label`` has (a, component) of the nodes that are linked; others are a component of their own. ``sizes`` has
    the size of every node's set.
    """
    members = ways.select("target").distinct().join(label.select(F.col("component").alias("target"), F.col("a").alias("node")), "target")
    asking = ways.join(label.select(F.col("component").alias("asking"), F.col("a").alias("node")), "asking", "left").select("target", F.coalesce("node", "asking").alias("node"))
    members, asking = (stage(df.join(sizes, "node"), "met") for df in (members, asking))

    def parts(df, most, name):
        pieces = F.greatest(F.ceil(F.count(F.lit(1)) / most), F.ceil(F.sum("size") * 8 / SIDE_BYTES)).cast("int")
        return df.groupBy("target").agg(pieces.alias(name))

    dealt = stage(parts(members, BLOCK, "blocks").join(parts(asking, ASKING, "chunks"), "target"), "dealt")
    sets, at_sets = sets_of(members.select("node").union(asking.select("node")).distinct())
    own = lambda n: F.pmod(F.xxhash64(F.lit("part"), "node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = members.join(dealt, "target").select("target", "node", own("blocks").alias("block"), "chunks").select("*", every("chunks").alias("chunk"))
    right = asking.join(dealt, "target").select("target", "node", own("chunks").alias("chunk"), "blocks").select("*", every("blocks").alias("block"))
    # Columns of their own on either side, though both read the same sets.
    left, right = (df.join(sets, "node").select(*[F.col(c).alias(f"{side}_{c}") for c in ("target", "block", "chunk", "node", "shingles")]) for side, df in (("of", left), ("by", right)))
    left, right = (df.groupBy(*df.columns[:3]) for df in (left, right))
    found = stage(left.cogroup(right).applyInArrow(_meet(similarity), "a long, b long"), "found")
    drop(ways.sparkSession, at_sets)
    return found


def _most(bits: int, similarity: float, deviations: int) -> int:
    """Differing signs that a linked pair has at most, so many deviations above the mean."""
    differ = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return math.ceil(bits * differ + deviations * math.sqrt(bits * differ * (1 - differ)))


def _possible(similarity: float, most: int):
    """Condition on (size, sieve) and (size2, sieve2)."""
    sizes = F.least("size", "size2") >= F.lit(similarity) * F.greatest("size", "size2") - 1e-6
    return sizes & (F.bit_count(F.col("sieve").bitwiseXOR(F.col("sieve2"))) <= most)


def _pair(df: DataFrame) -> DataFrame:
    return df.select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct()


def _buckets(put: DataFrame) -> DataFrame:
    """(key, node, size, sieve, n, lead) of the keys that several nodes share; ``lead`` is one of them."""
    lead = F.struct(F.xxhash64("key", "node").alias("order"), "node", "size", "sieve")
    top = put.agg(F.call_function("approx_top_k", "key", F.lit(FREQUENT), F.lit(TRACKED)).alias("top")).select(F.explode("top").alias("t"))
    hot = F.broadcast(stage(top.where(F.col("t.count") > MANY).select(F.col("t.item").alias("key")), "hot"))
    by = Window.partitionBy("key")
    cold = put.join(hot, "key", "left_anti").withColumn("n", F.count(F.lit(1)).over(by)).withColumn("lead", F.min(lead).over(by)).where("n > 1")
    # At most FREQUENT rows.
    groups = stage(put.join(hot, "key").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(lead).alias("lead")), "groups")
    return cold.unionByName(put.join(F.broadcast(groups), "key"))


def _ring_buckets(nodes: DataFrame, n: int) -> DataFrame:
    """The buckets of the fingerprints' keys."""
    masks = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(x).alias("mask")) for i, x in enumerate(key_masks(cuts(RING, n), RING))])
    put = nodes.select("node", "size", "sieve", F.explode(masks).alias("cut"))
    put = put.select(F.xxhash64(F.col("cut.i"), F.col("sieve").bitwiseAND(F.col("cut.mask"))).alias("key"), "node", "size", "sieve")
    return stage(_buckets(put), "ring")


def _ring(nodes: DataFrame, n: int, met: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) of ``nodes`` whose fingerprints differ in RING bits at most; ``met`` are their buckets, if they are written.

    Every node of a key meets one of them; where a key has over PAIRED nodes its other pairs are not made here.
    """
    m, met = cuts(RING, n), _ring_buckets(nodes, n) if met is None else met
    differ = F.col("sieve").bitwiseXOR(F.col("sieve2"))
    near = (F.col("node") != F.col("node2")) & (F.bit_count(differ) <= RING) & within_budgets(differ, m, RING)
    stars = met.select("node", "sieve", F.col("lead.node").alias("node2"), F.col("lead.sieve").alias("sieve2")).where(near)
    few = met.where(F.col("n").between(3, PAIRED)).select("key", "node", "sieve")
    pairs = few.join(few.select("key", F.col("node").alias("node2"), F.col("sieve").alias("sieve2")), "key").where(near & (F.col("node") < F.col("node2")))
    return _pair(stars.select("node", "node2").unionByName(pairs.select("node", "node2")))


def linked_rows(rows: DataFrame, similarity: float, shingle: int, recall: float) -> DataFrame:
    """(row, keep): the row that stays of each row's group; ``rows`` has (row, id, text), written once."""
    spark, total_rows = rows.sparkSession, rows.count()
    sizes, bands = plan(total_rows, similarity, recall)
    made = rows.select("row", "text").mapInArrow(_nodes(shingle, sizes, bands), "row long, node long, size int, sieve long, keys array<int>, " + ", ".join(f"{w} long" for w in _ODD))
    made, made_path = stage_at(made, "shingled")
    firsts = made.select("row", "node").join(rows.select("row", "id"), "row")
    firsts = firsts.groupBy("node").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = stage(firsts, "firsts")
    distinct = firsts.count()
    # Equal sets have equal keys: the first row's stand for all.
    leads = firsts.select("node", F.col("first.row").alias("row"))
    # Of two different sets of n and more shingles at most n / (n + 1) is shared.
    least = math.ceil(similarity / (1 - similarity) - 1e-9)
    nodes = made.join(leads.select("row"), "row", "left_semi").where(F.col("size") >= least)
    put = nodes.select("node", "size", "sieve", F.posexplode("keys").alias("band", "key"))
    put = put.withColumn("key", F.shiftleft(F.col("band").cast("long"), 32).bitwiseOR(F.col("key").cast("long"))).drop("band")
    shared, shared_path = stage_at(_buckets(put), "shared")
    odd = stage(nodes.select("node", *_ODD), "odd")
    near = _ring_buckets(nodes, distinct)
    ring = stage(_ring(nodes, distinct, near), "ringed")
    rows_of = stage(made.select("row", "node", "size"), "nodes")
    drop(spark, made_path)
    most = _most(64, similarity, 4)
    possible = _possible(similarity, most)

    def sets_of(wanted):
        texts = rows.select("row", "text").join(wanted.join(leads, "node"), "row").select("node", "text")
        return stage_at(texts.mapInArrow(_sets(shingle), "node long, shingles binary"), "sets")

    def confirmed(pairs):
        pairs, at_pairs = stage_at(pairs, "candidates")
        sets, at_sets = sets_of(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
        left, right = (sets.select(F.col("node").alias(k), F.col("shingles").alias(f"s{k}")) for k in "ab")
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb")
        found = stage(both.mapInArrow(_confirm(similarity), "a long, b long"), "confirmed")
        drop(spark, at_pairs, at_sets)
        return found

    # All members of a bucket against one of them, and fingerprints that are near.
    stars = shared.select("node", "size", "sieve", F.col("lead.node").alias("node2"), F.col("lead.size").alias("size2"), F.col("lead.sieve").alias("sieve2"))
    label = stage(components(confirmed(_pair(stars.where("node <> node2").where(possible)).union(ring).distinct())), "label")

    # What is left: pairs of nodes of one bucket in different components.
    open_ = shared.where("n > 2").unionByName(near.where(F.col("n") > PAIRED)).select("key", "node", "size", "sieve")
    open_ = open_.join(label.withColumnRenamed("a", "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    open_, open_path = stage_at(open_, "open")
    drop(spark, shared_path)
    parts = open_.groupBy("key", "component").agg(F.count(F.lit(1)).alias("members"), F.min("size").alias("low"), F.max("size").alias("high"), F.min("sieve").alias("sieve"), F.min("node").alias("node"))
    mixed = parts.groupBy("key").agg(F.count(F.lit(1)).alias("parts")).where("parts > 1")
    parts = stage(parts.join(mixed, "key"), "parts")

    def meeting(parts, unlike):
        # Components whose sizes exclude any link do not meet, nor do single nodes that are ``unlike`` each other.
        near = (F.col("x.high") >= F.lit(similarity) * F.col("y.low") - 1e-6) & (F.col("y.high") >= F.lit(similarity) * F.col("x.low") - 1e-6)
        near &= (F.col("x.members") > 1) | (F.col("y.members") > 1) | ~unlike
        return parts.alias("x").join(parts.alias("y"), "key").where("x.component < y.component").where(near).select("key", F.col("x.component").alias("component"), F.col("y.component").alias("component2"))

    bits = lambda *columns: sum((F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in columns), F.lit(0))
    unlike = bits("sieve") > most
    crowd = stage(parts.where(F.col("parts") >= CROWD).join(odd, "node"), "crowd")
    # A linked pair's sets differ in so many hashes at most.
    apart = bits(*_ODD) > F.lit((1 - similarity) / (1 + similarity)) * (F.col("x.high") + F.col("y.high")) + 1e-6
    ways = meeting(parts.where(F.col("parts") < CROWD), unlike).unionByName(meeting(crowd, unlike | apart))
    ways = stage(ways, "ways")
    # Components of one bucket after the other by their members in all; only the large ones need to be listed.
    large = label.groupBy("component").agg(F.count(F.lit(1)).alias("total")).where(F.col("total") >= LARGE)
    large = stage(large, "large")
    known = ways.join(large.select("component", F.col("total").alias("one")), "component", "left").join(large.select(F.col("component").alias("component2"), F.col("total").alias("two")), "component2", "left")
    known = known.select("key", "component", "component2", F.coalesce("one", F.lit(0)).alias("one"), F.coalesce("two", F.lit(0)).alias("two"))
    second = F.col("two") > F.col("one")
    blocks = known.where("one + two > 0").select(F.when(second, F.col("component")).otherwise(F.col("component2")).alias("asking"), F.when(second, F.col("component2")).otherwise(F.col("component")).alias("target")).distinct()
    met = _in_blocks(blocks, label, rows_of.select("node", "size").distinct(), sets_of, similarity)
    ways = known.where("one + two = 0").select("key", "component", "component2")
    other = open_.select("key", F.col("component").alias("component2"), F.col("node").alias("node2"), F.col("size").alias("size2"), F.col("sieve").alias("sieve2"))
    rest = open_.join(ways, ["key", "component"]).join(other, ["key", "component2"]).where(possible)
    late = confirmed(_pair(rest))
    drop(spark, open_path)

    label = components(label.select("a", F.col("component").alias("b")).unionByName(late).unionByName(met))
    named = firsts.join(label.withColumnRenamed("a", "node"), "node", "left").select("node", "n", "first", F.coalesce("component", "node").alias("component"))
    named = stage(named, "labelled")
    heads = named.groupBy("component").agg(F.min("first").alias("head"), F.count(F.lit(1)).alias("members"))
    named = attach(named, stage(heads, "heads"), "component", "members", distinct).select("node", "n", F.col("head.row").alias("keep"))
    return attach(rows_of.select("row", "node"), stage(named, "named"), "node", "n", total_rows).select("row", "keep")


@tidy
def drop_similar(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, recall: float = 0.995, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of linked rows stays; all columns are kept."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = numbered(docs.toDF(*names), "row")
    rows = plain.select("row", F.col(names[docs.columns.index(id_col)]).alias("id"), F.col(names[docs.columns.index(text_col)]).alias("text"))
    gone = stage(linked_rows(rows, similarity, shingle, recall).where("row <> keep").select("row"), "gone")
    return plain.join(gone, "row", "left_anti").select(*names).toDF(*docs.columns)
