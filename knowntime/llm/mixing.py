"""Mixing sources to target weights by the cube method.

Each source gets a target number of words; a document is taken floor(pi) times
and once more with its fractional inclusion probability, pi = target / size of
the source. The cube method moves the fractional probabilities of a block of
documents along null-space directions of two constraints, the expected number
of documents and of words, until at most two stay fractional. What is left of
all blocks of a source is put together and moves on in the same way, round by
round, until one block a source remains; its last documents land on the choice
whose word total is nearest.

Targets: a source's share of ``total`` is by weight, capped at ``most`` times
its size, and the excess goes to the others by weight until no cap is passed:
the level at which min(cap, level * weight) adds up to the total.

Scale: blocks hold about ``block`` documents of one source, so a source with a
third of all rows is many blocks; each round keeps two rows of a block. Draws
depend on (seed, source, block) and documents are ordered by a hash and their id,
so reruns agree. Sources are one narrow row each; only to set the level do these rows meet in
one task. Documents meet their source's row by :func:`attach`, so that sources may be many.

Edge cases: a null text has size 0; documents of size 0 are taken 0 times and a
source without words has target 0. A null source is one source, last in order.
Rows that share an id are drawn each on their own, by their text too: rows that agree
in both are dealt in an order of no meaning. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .skew import attach
from .staging import numbered, stage, tidy

WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sized: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """(source, source_size, target, rows): one row a source."""
    sums = stage(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")), "sources")
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    by = sums.withColumn("w", F.get(cycle, (F.row_number().over(order) - 1) % len(weights))).withColumn("cap", F.col("source_size") * float(most))
    by = by.withColumn("total", F.sum("source_size").over(Window.partitionBy()) * float(share))
    # Sources in the order in which they reach their cap. With all before one capped, the rest share what is left;
    # the first source that this level does not fill sets the level.
    up = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    capped = F.coalesce(F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("w").over(up.rowsBetween(0, Window.unboundedFollowing))
    by = by.withColumns({"level": (F.col("total") - capped) / rest, "nth": F.row_number().over(up)})
    first = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct("nth", "level"))).over(Window.partitionBy())
    by = by.withColumn("level", first["level"])
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("w")))
    return stage(by.select("source", "source_size", target.alias("target"), "rows"), "targets")


def _of_source():
    """A source as a key that is never null."""
    return F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name"))


def flight(p: np.ndarray, x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move probabilities in [0, 1] to 0 or 1, all but two at most, keeping sum(p) and sum(p * x).

    Three fractional units at a time: the null space of two constraints over
    three units is the cross product of (1, 1, 1) and their sizes.
    """
    p = p.astype(float).copy()
    waiting = [i for i in range(len(p)) if 0.0 < p[i] < 1.0]
    draws, d = rng.random(len(waiting) + 1), 0
    at, held = 0, []
    while True:
        while len(held) < 3 and at < len(waiting):
            held.append(waiting[at])
            at += 1
        if len(held) < 3:
            return p
        i, j, k = held
        u = (x[k] - x[j], x[i] - x[k], x[j] - x[i])
        if u == (0, 0, 0):
            u = (1.0, -1.0, 0.0)
        up = min((1 - p[h]) / v if v > 0 else p[h] / -v for h, v in zip(held, u) if v)
        down = min(p[h] / v if v > 0 else (1 - p[h]) / -v for h, v in zip(held, u) if v)
        step = up if draws[d] * (up + down) < down else -down
        d += 1
        for h, v in zip(held, u):
            p[h] = min(1.0, max(0.0, p[h] + step * v))
            if p[h] < 1e-9 or p[h] > 1 - 1e-9:
                p[h] = round(p[h])
        held = [h for h in held if 0.0 < p[h] < 1.0]


def land(p: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Round the at most two fractional units to the nearest total of x, then of units."""
    left = [i for i in range(len(p)) if 0.0 < p[i] < 1.0]
    words, units = sum(p[i] * x[i] for i in left), sum(p[i] for i in left)
    best = min(range(1 << len(left)), key=lambda c: (abs(sum(x[i] for b, i in enumerate(left) if c >> b & 1) - words), abs(c.bit_count() - units), c))
    p = p.copy()
    for b, i in enumerate(left):
        p[i] = best >> b & 1
    return p


def _round(seed: int, last: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["place", "id", "size", *(["row"] if "row" in pdf else [])], kind="stable")
        key = f"{seed}|{pdf['source'].iloc[0]}|{pdf['block'].iloc[0]}".encode()
        rng = np.random.default_rng(int.from_bytes(hashlib.sha256(key).digest()[:8], "big"))
        sizes = [int(v) for v in pdf["size"]]
        p = flight(pdf["p"].to_numpy(float), sizes, rng)
        return pdf.assign(p=land(p, sizes) if last else p)

    return run


@tidy
def mix_sources(
    docs: DataFrame, weights=(3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0, block: int = 2000, seed: int = 1,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", row_col: str | None = None,
) -> DataFrame:
    """(id, size, source_size, target, copies, taken) of every row.

    ``row_col`` names a unique number of the row, which is then the first column:
    ids may repeat or be null, and rows are dealt by their text too.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    place = F.xxhash64(F.lit(seed), F.col(id_col), *([F.col(text_col)] if row_col else []))
    row = [F.col(row_col).cast("long").alias("row")] if row_col else []
    rows = docs.select(*row, F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"), size.alias("size"), place.alias("place"))
    rows = stage(rows, "sizes")
    targets = source_targets(rows, list(weights), share, most)
    rate = F.when(F.col("size") == 0, 0.0).otherwise(F.least(F.lit(float(most)), F.col("target") / F.col("source_size")))
    joined = attach(rows.withColumn("s", _of_source()), targets.withColumn("s", _of_source()).drop("source"), "s", "rows", rows.count()).drop("rows")
    joined = joined.withColumn("rate", rate).withColumn("whole", F.floor("rate")).withColumn("p", F.col("rate") - F.col("whole"))

    # A block of a source: its rows are dealt by their hash.
    open_, parts, columns = joined.where("p > 0 and p < 1"), [joined.where("p = 0 or p >= 1")], joined.columns
    schema = joined.limit(0).withColumn("block", F.lit(0).cast("long")).schema
    step = 0
    while True:
        counts = open_.groupBy("source").agg(F.count(F.lit(1)).alias("_rows"))
        counts = stage(counts.select(_of_source().alias("s"), "_rows", F.ceil(F.col("_rows") / block).cast("long").alias("_blocks")), "blocks")
        most_blocks, left = counts.agg(F.max("_blocks"), F.sum("_rows")).first()
        if most_blocks is None:
            break
        last = most_blocks == 1
        dealt = attach(open_, counts, "s", "_rows", left).withColumn("block", F.pmod(F.xxhash64(F.lit(step), "place"), "_blocks"))
        moved = stage(dealt.select(*columns, "block").groupBy("source", "block").applyInPandas(_round(seed + step, last), schema).select(*columns), "moved")
        parts.append(moved.where("p = 0 or p = 1"))
        open_, step = moved.where("p > 0 and p < 1"), step + 1
        if last:
            break
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    copies = (F.col("whole") + F.round("p")).cast("long")
    row = [F.col("row").alias(row_col)] if row_col else []
    return out.select(*row, F.col("id").alias(id_col), "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


@tidy
def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as the mix takes it, all columns kept.

    Rows are told apart by a number written with them, so ids may repeat or be null.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    of = {k: names[docs.columns.index(c)] for k, c in (("id_col", id_col), ("text_col", text_col), ("source_col", source_col))}
    rows = numbered(docs.toDF(*names), "row")
    times = mix_sources(rows, row_col="row", **of, **options).select("row", "copies").where("copies > 0")
    return rows.join(times, "row").select(*names, F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(*names).toDF(*docs.columns)
