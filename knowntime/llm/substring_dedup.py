"""Substring dedup: Rabin-Karp hashes of word windows, counted in Spark.

A window is ``size`` consecutive words. A word is removed if a window over it
has a word sequence that also starts in a document with a smaller id. Windows
are judged on the input; removed words merge into maximal intervals.

The work is done in two passes so that unrepeated text never leaves its task.
Two equal windows have the same smallest hash among their ``size // 2``-grams,
their anchor. Pass one counts anchors by document: only a window whose anchor
is in two documents can repeat, so nothing is lost. Pass two hashes every window
over such anchors with two hashes, over words hashed in two independent ways, and finds the smallest
document of each hash (96 bits). Anchors and windows are sent as numbers, never as text.

Scale: about 2 in ``size // 2`` words make an anchor row. Anchors in over
``heavy`` documents mark heavy windows; these are counted with partial
aggregation and joined back in a splittable join, all others share one window
sort, where a group holds at most ``heavy`` documents. What is gathered for one
document is bounded by its own length.

Edge cases: a null text has no words; a text shorter than a window loses
nothing; within one document repeats stay. Ids are taken to be unique; rows
that share one are one document, and each loses the union of what is found.
A null id has no order: such rows are returned whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import stage, tidy
from .vectortext import grams, rehash, slabs, sliding_min, words

#: An odd base for the second hash of a word.
SECOND = 0xD1B54A32D192ED03


def _anchors(w, size: int):
    """(start word, document, anchor) of every window inside one document."""
    gram = size // 2
    anchor = sliding_min(grams(w.hash, gram), size - gram + 1)
    n = len(anchor)
    own = w.doc[:n] == w.doc[size - 1 : size - 1 + n]
    at = np.flatnonzero(own)
    return at, w.doc[at], anchor[at]


def _emit_anchors(size: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for a, b, texts in slabs(batch.column(1)):
                _, doc, anchor = _anchors(words(texts), size)
                new = np.ones(len(doc), bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(anchor[new].view(np.int64)), pa.array(ids[a:b][doc[new]], pa.int64())], ["anchor", "doc"])

    return run


def _emit_windows(size: int):
    """Every window over one of the document's listed anchors."""

    def run(batches):
        for batch in batches:
            ids, listed = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2)
            for a, b, texts in slabs(batch.column(1)):
                w = words(texts)
                at, doc, anchor = _anchors(w, size)
                bounds = np.searchsorted(doc, np.arange(b - a + 1))
                keep = np.zeros(len(doc), bool)
                for d in range(b - a):
                    s = slice(bounds[d], bounds[d + 1])
                    keep[s] = np.isin(anchor[s], listed[a + d].values.to_numpy().view(np.uint64))
                at, doc = at[keep], doc[keep]
                h1, h2 = grams(w.hash, size)[at], grams(rehash(w, SECOND), size)[at]
                # One row for a window and document, however often it repeats there.
                order = np.lexsort((at, h1, doc))
                at, doc, h1, h2 = at[order], doc[order], h1[order], h2[order]
                new = np.ones(len(at), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
                pos, first = (at - w.first[doc]).astype(np.int32), np.flatnonzero(new)
                extra = np.diff(np.append(first, len(at))) - 1
                more = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(extra))), pa.int32()), pa.array(pos[~new]), mask=pa.array(extra == 0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h1[first].view(np.int64)), pa.array((h2[first] >> np.uint64(32)).astype(np.uint32).view(np.int32)), pa.array(ids[a:b][doc[first]], pa.int64()), pa.array(pos[first]), more],
                    ["h1", "h2", "doc", "pos", "more"])

    return run


def _removed(pos: np.ndarray, size: int, n: int) -> np.ndarray:
    """Mask of the words under windows at ``pos``."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, pos, 1)
    np.add.at(change, np.minimum(pos + size, n), -1)
    return np.cumsum(change[:n]) > 0


def _cut(size: int):
    def run(batches):
        for batch in batches:
            ids, starts = batch.column(0), batch.column(2)
            for a, b, texts in slabs(batch.column(1)):
                kept, n_words, n_removed, spans = [], [], [], []
                for d, t in enumerate(texts, a):
                    w, pos, edge = t.split(), starts[d].values, []
                    mask = np.zeros(len(w), bool)
                    if pos is not None and len(pos):
                        mask = _removed(pos.to_numpy(), size, len(w))
                        edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0])))).tolist()
                        w = [x for x, m in zip(w, mask.tolist()) if not m]
                    n_words.append(len(mask))
                    n_removed.append(int(mask.sum()))
                    spans.append([{"start": s, "end": e} for s, e in zip(edge[::2], edge[1::2])])
                    kept.append(b" ".join(w))
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary()).cast(pa.string()), pa.array([hashlib.sha256(k).hexdigest() for k in kept])],
                    ["id", "n_words", "n_removed", "spans", "kept_text", "kept_sha256"])

    return run


@tidy
def repeated_windows(docs: DataFrame, size: int = 50, id_col: str = "doc_id", text_col: str = "text", heavy: int = 2000) -> DataFrame:
    """(id, n_words, n_removed, spans, kept_text, kept_sha256) of every document.

    ``spans`` are the maximal removed intervals in words, end exclusive;
    ``kept_text`` joins the kept words by one space. Ids are integers.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    known = texts.where("doc is not null")
    anchors = stage(known.mapInArrow(_emit_anchors(size), "anchor long, doc long"), "anchors")
    shared = anchors.groupBy("anchor").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.count(F.lit(1)).alias("n")).where("lo < hi")
    shared = stage(shared.select("anchor", (F.col("n") > heavy).alias("heavy")), "shared")
    by_doc = anchors.join(shared, "anchor").groupBy("doc").agg(
        F.collect_set(F.when(~F.col("heavy"), F.col("anchor"))).alias("light"), F.collect_set(F.when(F.col("heavy"), F.col("anchor"))).alias("heavy"))
    by_doc = stage(by_doc, "by_doc")

    # One query from here on: its joins with the text all read the same exchange of it.
    def windows(kind):
        listed = known.join(by_doc.where(F.size(kind) > 0), "doc").select("doc", "text", kind)
        return listed.mapInArrow(_emit_windows(size), "h1 long, h2 int, doc long, pos int, more array<int>")

    smallest = F.min("doc").over(Window.partitionBy("h1", "h2"))
    light = windows("light").withColumn("lo", smallest).where("doc > lo").select("doc", "pos", "more")
    least = windows("heavy").groupBy("h1", "h2").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi").select("h1", "h2", "lo")
    later = light.unionByName(windows("heavy").join(stage(least, "least"), ["h1", "h2"]).where("doc > lo").select("doc", "pos", "more"))
    starts = later.groupBy("doc").agg(F.concat(F.collect_list("pos"), F.flatten(F.collect_list("more"))).alias("starts"))
    schema = "id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept_text string, kept_sha256 string"
    out = known.join(starts, "doc", "left").select("doc", "text", "starts").mapInArrow(_cut(size), schema)
    nameless = texts.where("doc is null").withColumn("starts", F.lit(None).cast("array<int>")).mapInArrow(_cut(size), schema)
    return out.unionByName(nameless).withColumnRenamed("id", id_col)
