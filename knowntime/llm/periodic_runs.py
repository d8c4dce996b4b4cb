"""Periodic runs of words: tiles by octaves of periods, solved apart and stitched by document and period.

A run of period q is a maximal stretch of words in which every word equals the one q
before it, q being its smallest period, of at least ``times`` periods and ``least`` words. Its matches (i with
word i = word i + q) are an unbroken stretch of at least 2q places, for ``times`` >= 3.

Octave k holds the periods 2**k to 2**(k+1) - 1. Words get names by doubling: the name of 2**j
words comes from those of its halves. A stretch of 2**(k+1) - 1 matches or more has
2**k places from a multiple c of 2**k on, so the name at c is compared with those at c + q, which are just
the next block of 2**k names: one comparison a word and octave finds every candidate. Chains of
such multiples are extended at both ends by binary descent over the names.

Tiles: a document of up to ``tile`` words is solved as a whole where it is read, together with
its neighbours, behind marks of their own. A longer one is exploded into tiles
for each group of octaves, each with the words its places look ahead to, dealt out over the cluster. A tile
reports the matches of its own places only: the candidates inside, and what the Z-functions of its two borders
say for every period (how far the matches go on from its first place and before its last). Fragments
are then shuffled by document and period, and those that touch are stitched.

Scale: documents without runs never leave their task; of the others the text is written once. A
tile of octave k has 18 * 2**k words, a period at most one fragment in each border.

Edge cases: a null text has no words. Every row is decided by itself, with a number of its own
where it has candidates, so repeated rows and null ids are rows like any other. Of equal stretches the
smallest period counts. An empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import numbered, stage, tidy
from .vectortext import mix, slabs, words

#: Octaves that share the lowest tiles of a long document; multiplier of a left half's name.
LOW, LEFT = 12, np.uint64(0xD6E8FEB86659FD93)
FRAGMENTS = "array<struct<period:long,start:long,stop:long>>"
RUNS = "array<struct<start:long,length:long,period:long>>"


class Names:
    """Names of 2**j consecutive words at every place of ``word``, doubled as they are asked for."""

    def __init__(self, word: np.ndarray, keep: int = 1):
        self.levels, self.keep = {0: word}, keep

    def level(self, j: int) -> np.ndarray:
        """Names of 2**j words; those of the levels between that are no multiples of ``keep`` are dropped."""
        top = max(self.levels)
        while top < j:
            half = self.levels[top]
            made = mix(half[: -(1 << top)] * LEFT + mix(half[1 << top :] + LEFT))
            if top % self.keep:
                del self.levels[top]
            top += 1
            self.levels[top] = made
        return self.levels[j]

    def forward(self, x: np.ndarray, y: np.ndarray, below: int) -> np.ndarray:
        """How many words from ``x`` and from ``y`` on are the same, up to less than 2**below."""
        return self._reach(x, y, below, 1)

    def backward(self, x: np.ndarray, y: np.ndarray, below: int) -> np.ndarray:
        """How many words right before ``x`` and ``y`` are the same, up to less than 2**below."""
        return self._reach(x, y, below, -1)

    def _reach(self, x, y, below, way):
        done, last = np.zeros(len(x), np.int64), below
        n = len(self.levels[0])
        for j in sorted((j for j in self.levels if j < below), reverse=True):
            names, size = self.levels[j], 1 << j
            for _ in range((1 << (last - j)) - 1):
                a, b = (x + done, y + done) if way > 0 else (x - done - size, y - done - size)
                inside = (np.minimum(a, b) >= 0) & (np.maximum(a, b) <= n - size)
                same = inside & (names[np.where(inside, a, 0)] == names[np.where(inside, b, 0)])
                if not same.any():
                    break
                done += same * size
            last = j
        return done


def chains(names: Names, k: int, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(period, start, stop) of all stretches of matches of octave k that hold 2**(k+1) - 1 places, and some shorter ones.

    ``at`` are the places that are looked at, ascending; whole documents.
    """
    size, level = 1 << k, names.level(k)
    at = np.arange(len(level)) if at is None else at[at < len(level)]
    rows = len(at) // size
    none = np.zeros(0, np.int64)
    if rows < 2:
        return none, none, none
    # The last block may be cut short: names there that do not exist match nothing.
    place = np.full(-(-len(at) // size) * size, -1)
    place[: len(at)] = at
    place = place.reshape(-1, size)
    block, offset = np.nonzero((level[place[:-1, :1]] == level[place[1:]]) & (place[1:] - place[:-1, :1] == np.arange(size, 2 * size)))
    if not len(block):
        return none, none, none
    order = np.lexsort((block, offset))
    block, period = block[order], offset[order] + size
    c = place[block, 0]
    # A chain goes on where the next multiple matches at the same period.
    goes_on = np.zeros(len(c), bool)
    goes_on[1:] = (period[1:] == period[:-1]) & (c[1:] == c[:-1] + size)
    head = np.flatnonzero(~goes_on)
    tail = np.append(head[1:], len(c)) - 1
    period, first, end = period[head], c[head], c[tail] + size
    start = first - names.backward(first, first + period, k + 1)
    return period, start, end + names.forward(end, end + period, k + 1)


def smallest(doc, period, start, stop):
    """Of stretches of matches that are the same run of words, the one of the smallest period."""
    order = np.lexsort((period, stop + period, start, doc))
    d, s, e = doc[order], start[order], (stop + period)[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (s[1:] != s[:-1]) | (e[1:] != e[:-1])
    return order[new]


def whole(hashes: np.ndarray, first: np.ndarray, times: int, least: int):
    """(document, period, start, stop) of the runs of whole documents, whose words are first[d] to first[d + 1]."""
    count, n_docs = np.diff(first), len(first) - 1
    doc = np.repeat(np.arange(n_docs), count)
    # A mark of its own behind every document is in no match, so no stretch of a period or more goes beyond it.
    marked = np.empty(len(hashes) + n_docs, np.uint64)
    marked[np.arange(len(hashes)) + doc] = hashes
    marked[first[1:] + np.arange(n_docs)] = mix(np.arange(1, n_docs + 1).astype(np.uint64) * LEFT)
    begin, names, found = first[:-1] + np.arange(n_docs), Names(marked), []
    owner = np.repeat(np.arange(n_docs), count + 1)
    for k in range(max(0, int(count.max(initial=0)) // times).bit_length()):
        at = np.flatnonzero(count[owner] >= times << k)
        period, start, stop = chains(names, k, at)
        long = stop - start + period >= np.maximum(least, times * period)
        period, start, stop = period[long], start[long], stop[long]
        found.append((owner[start], period, start - begin[owner[start]], stop - begin[owner[start]]))
    doc, period, start, stop = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found) if found else [()] * 4))
    keep = smallest(doc, period, start, stop)
    return doc[keep], period[keep], start[keep], stop[keep]


def octaves(n: int, tile: int, times: int) -> list[tuple[int, int, int]]:
    """(first octave, last octave, own places of a tile) for a document of n words."""
    top = (n // times).bit_length() - 1
    groups = [(0, min(LOW - 1, top), max(tile, 1 << LOW))]
    return groups + [(k, k, max(tile, 16 << k)) for k in range(LOW, top + 1)]


def tiles(hashes: np.ndarray, tile: int, times: int):
    """(first octave, last octave, place of the first word, own places, words) of all tiles of a document."""
    for low, high, own in octaves(len(hashes), tile, times):
        for a in range(0, len(hashes), own):
            yield low, high, a, min(own, len(hashes) - a), hashes[a : a + own + (2 << high)]


def solve(word: np.ndarray, low: int, high: int, own: int, is_first: bool, is_last: bool):
    """(period, start, stop) of a tile's fragments: matches of its own places."""
    names, found = Names(word, 1 if high < LOW else 4), []
    for k in range(low, high + 1):
        found.append(chains(names, k))
        period = np.arange(1 << k, 2 << k)
        period = period[period < len(word)]
        deep = own.bit_length() + 1
        if not is_first:
            border = np.zeros(len(period), np.int64)
            found.append((period, border, names.forward(border, period, deep)))
        if not is_last:
            border = np.full(len(period), own, np.int64)
            found.append((period, own - names.backward(border, border + period, deep), border))
    period, start, stop = (np.concatenate(x) for x in zip(*found))
    start, stop = np.maximum(start, 0), np.minimum(stop, own)
    some = stop > start
    return period[some], start[some], stop[some]


def _structs(type_, doc, rows, *columns) -> pa.Array:
    """Lists of structs, a list a document; ``doc`` ascending."""
    kind = pa.struct([(f, pa.int64()) for f in type_])
    values = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=list(kind))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(rows + 1)), pa.int32()), values)


def _joined(w, keep: np.ndarray) -> pa.Array:
    """The kept words of every document, joined by one space."""
    # The byte after a word is a separator: it becomes the space between.
    edge = np.zeros(len(w.data) + 1, np.int8)
    edge[w.start[keep]] += 1
    edge[w.end[keep] + 1] -= 1
    data = w.data.copy()
    data[w.end] = 0x20
    data = data[np.cumsum(edge[:-1], dtype=np.int8).astype(bool)]
    ends = np.concatenate(([0], np.cumsum(np.where(keep, w.end - w.start + 1, 0))))[w.first]
    return pa.array([data[a : max(a, b - 1)].tobytes().decode() for a, b in zip(ends[:-1], ends[1:])], pa.string())


def _read(tile: int, times: int, least: int):
    def run(batches):
        for batch in batches:
            for a, b, texts in slabs(batch.column(1)):
                w = words(texts)
                count = np.diff(w.first)
                short = np.where(count <= tile, count, 0)
                inside = np.repeat(count <= tile, count)
                first = np.concatenate(([0], np.cumsum(short)))
                doc, period, start, stop = whole(w.hash[inside], first, times, least)
                cut = [list(tiles(w.hash[x:y], tile, times)) if y - x > tile else [] for x, y in zip(w.first[:-1], w.first[1:])]
                cut = [[{"low": t[0], "high": t[1], "at": t[2], "own": t[3], "n": int(n), "words": t[4].tobytes()} for t in listed] for listed, n in zip(cut, count)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(count, pa.int64()), _joined(w, np.ones(len(w.hash), bool)), _structs(("period", "start", "stop"), doc, b - a, period, start, stop), pa.array(cut, TILE)],
                    ["id", "n_words", "text", "found", "tiles"])

    return run


TILE = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64()), ("at", pa.int64()), ("own", pa.int64()), ("n", pa.int64()), ("words", pa.binary())]))


def _solve(batches):
    for batch in batches:
        for r in batch.to_pylist():
            t = r["tile"]
            period, start, stop = solve(np.frombuffer(t["words"], np.uint64), t["low"], t["high"], t["own"], t["at"] == 0, t["at"] + t["own"] >= t["n"])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(period), r["row"])), pa.array(period), pa.array(start + t["at"]), pa.array(stop + t["at"])], ["row", "period", "start", "stop"])


def _collapse(batches):
    for batch in batches:
        for a, b, texts in slabs(batch.column(1)):
            w = words(texts)
            gone = np.zeros(len(w.hash) + 1, np.int64)
            for d, runs in enumerate(batch.column(2).slice(a, b - a).to_pylist()):
                for r in runs:
                    gone[w.first[d] + r["start"] + r["period"]] += 1
                    gone[w.first[d] + r["start"] + r["length"]] -= 1
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), _joined(w, np.cumsum(gone)[:-1] == 0)], ["row", "text"])


def stitched(fragments: DataFrame, times: int, least: int) -> DataFrame:
    """(row, start, length, period) of the runs that ``fragments`` (row, period, start, stop) are parts of."""
    order = Window.partitionBy("row", "period").orderBy("start", "stop")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    parts = fragments.withColumn("new", (F.coalesce(reach, F.lit(-1)) < F.col("start")).cast("int"))
    parts = parts.withColumn("part", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    length = F.max("stop") - F.min("start") + F.col("period")
    runs = parts.groupBy("row", "period", "part").agg(F.min("start").alias("start"), length.alias("length"))
    return runs.where(F.col("length") >= F.greatest(F.lit(least), F.col("period") * times)).groupBy("row", "start", "length").agg(F.min("period").alias("period"))


@tidy
def periodic_runs(docs: DataFrame, times: int = 3, least: int = 24, tile: int = 1 << 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, runs, text): runs by start, then period; text without the words of a run after its first period, joined by spaces."""
    if times < 3 or least < 3 * times:
        raise ValueError("runs of fewer than three periods, or than 9 words, are not found")
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = plain.schema["id"].dataType.simpleString()
    tile_type = "array<struct<low:long,high:long,at:long,own:long,n:long,words:binary>>"
    read = plain.mapInArrow(_read(tile, times, least), f"id {kind}, n_words long, text string, found {FRAGMENTS}, tiles {tile_type}")
    open_ = (F.size("found") > 0) | (F.size("tiles") > 0)
    some = numbered(read.where(open_), "row")
    dealt = some.select("row", F.explode("tiles").alias("tile")).repartition(F.col("row"), F.col("tile.low"), F.col("tile.at"))
    fragments = some.select("row", F.inline("found")).unionByName(dealt.mapInArrow(_solve, "row long, period long, start long, stop long"))
    runs = stitched(fragments, times, least).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    runs = stage(runs.select("row", F.transform("runs", lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period"))).alias("runs")), "runs")
    having = some.select("row", "text").join(runs, "row").mapInArrow(_collapse, "row long, text string")
    ended = some.select("row", "id", "n_words", F.col("text").alias("whole")).join(runs, "row", "left").join(having, "row", "left")
    none = F.array().cast(RUNS)
    ended = ended.select("id", "n_words", F.coalesce("runs", none).alias("runs"), F.coalesce("text", "whole").alias("text"))
    return read.where(~open_).select("id", "n_words", none.alias("runs"), "text").unionByName(ended).withColumnRenamed("id", id_col)
