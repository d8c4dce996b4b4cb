"""Benchmark decontamination by winnowing; DataFrame functions only.

A text is a sequence of word hashes. Of every ``span`` consecutive words the
smallest ``k``-gram hash is kept as fingerprint, so that any shared run of
``span`` words has a shared fingerprint. Corpus fingerprints are looked up
among those of the test items; a hit is extended to the full window and its
words are compared.

Scale: a window's fingerprint is a fixed expression over the hashes of its words, inside generated code. The item
fingerprints are broadcast while they number at most ``max_broadcast``, and only windows whose
fingerprint hits leave the scan. Beyond that windows are shuffled as (document, start,
length, fingerprint), a few bytes a word; what hits goes back to the text by its document.
What is gathered for one document is bounded by its own length.

Edge cases: a null or empty text has no words and cannot be hit. An item of
fewer than ``span`` words is one window of its own length; one without words is
ignored. Repeated items count once by item_id. Every row has a verdict of its own, whatever
its id: a document is known by its id and text. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import numbered, stage, tidy

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Odd multiplier of the rolling hash (the golden ratio in 64 bits).
MULTIPLIER = -7046029254386353131


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; ``lower`` is the faster way where all is ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BREAKS), "")


def _mix(total: Column, word: Column) -> Column:
    return F.xxhash64(total.bitwiseXOR(word * F.lit(MULTIPLIER)), word)


def fingerprint(hashes: Column, start: Column, length: int, k: int) -> Column:
    """The smallest hash of the k-grams inside ``length`` words from 0-based ``start``."""
    k = min(k, length)
    at = [F.get(hashes, (start + F.lit(i)).cast("int")) for i in range(length)]
    grams = [F.xxhash64(*at[i : i + k]) for i in range(length - k + 1)]
    return grams[0] if len(grams) == 1 else F.least(*grams)


def _windows(df: DataFrame, lengths: list[int], k: int) -> DataFrame:
    """Each start of each length with its fingerprint."""
    made = [F.struct(F.lit(size).alias("length"), fingerprint(F.col("hashes"), F.col("start"), size, k).alias("fp")) for size in lengths]
    n = F.size("words")
    least = F.lit(min(lengths))
    # Null, so no rows, for shorter texts; a filter would be pushed below the split and split twice.
    out = df.withColumn("start", F.explode(F.when(n >= least, F.sequence(F.lit(0), n - least))))
    out = out.withColumn("w", made[0] if len(made) == 1 else F.explode(F.array(*made))).where(F.col("start") + F.col("w.length") <= n)
    return out.select("*", F.col("w.length").alias("length"), F.col("w.fp").alias("fp")).drop("w")


def _window_text() -> Column:
    return F.array_join(F.slice("words", F.col("start") + 1, F.col("length")), " ")


def _same(left: str, right: str) -> Column:
    return F.expr(f"{left}.id <=> {right}.id AND {left}.own = {right}.own")


def _found(words: DataFrame, lengths: list[int], k: int, prints: DataFrame, broadcast: bool) -> DataFrame:
    """(id, own, start, length, window) of the windows whose fingerprint is one of ``prints``."""
    starts = _windows(words.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w))), lengths, k)
    if broadcast:
        return starts.join(F.broadcast(prints), F.col("fp") == F.col("test_fp")).select("id", "own", "start", "length", _window_text().alias("window"))
    hits = starts.select("id", "own", "start", "length", "fp").join(prints, F.col("fp") == F.col("test_fp"), "left_semi")
    hits = stage(hits.groupBy("id", "own").agg(F.collect_set(F.struct("start", "length")).alias("at")), "hits")
    back = words.alias("d").join(hits.alias("h"), _same("d", "h")).select("d.id", "d.own", "words", "at")
    return back.withColumn("at", F.explode("at")).select("id", "own", "words", "at.start", "at.length").select("id", "own", "start", "length", _window_text().alias("window"))


@tidy
def contaminated_words(
    docs: DataFrame, items: DataFrame, span: int = 10, k: int = 5, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", max_broadcast: int = 2_000_000,
) -> DataFrame:
    """One row per document: id, n_words, n_hit and the sorted ``items`` that occur."""
    test = items.select(F.col(item_col).cast("string").alias("item"), words_of(F.col(item_text_col)).alias("words")).where("size(words) > 0")
    test = test.select("*", F.size("words").alias("n"), F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    lengths = sorted({r[0] for r in test.select(F.least("n", F.lit(span))).distinct().collect()}) or [span]
    parts = [_windows(test.where(F.col("n") >= span if size == span else F.col("n") == size), [size], k) for size in lengths]
    windows = stage(reduce(DataFrame.unionByName, parts).select("item", "length", "fp", _window_text().alias("window")).distinct(), "windows")
    prints = windows.select(F.col("fp").alias("test_fp")).distinct()

    text = F.col(text_col)
    words = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("own"), words_of(text).alias("words"))
    found = stage(_found(words, lengths, k, prints, prints.count() <= max_broadcast), "found")

    texts = windows.select("window").distinct()
    hits = found.join(texts, "window").select("id", "own", "start", "length", "window")
    covered = hits.groupBy("id", "own").agg(F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end")))).alias("spans"))
    # One walk over a document's sorted spans: the words so far, and how far they reach.
    walked = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["to"], s["start"]))).alias("n"), F.greatest(a["to"], s["end"]).alias("to")),
        lambda a: a["n"].cast("long"),
    )
    covered = covered.select("id", "own", walked.alias("n_hit"))
    which = hits.select("id", "own", "window").distinct().join(windows.select("window", "item"), "window")
    which = which.groupBy("id", "own").agg(F.array_sort(F.collect_set("item")).alias("items"))
    marked = stage(covered.alias("c").join(which.alias("w"), _same("c", "w")).select("c.id", "c.own", "n_hit", "items"), "marked")
    per_doc = words.select("id", "own", F.size("words").cast("long").alias("n_words"))
    joined = per_doc.alias("d").join(marked.alias("m"), _same("d", "m"), "left")
    return joined.select(
        F.col("d.id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


@tidy
def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows without any hit, with all their columns; rows that share an id are told apart by a number written with them."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = numbered(docs.toDF(*names), "row")
    hit = contaminated_words(rows, items, id_col="row", text_col=names[docs.columns.index(text_col)], **options).where("n_hit > 0").select("row")
    return rows.join(stage(hit, "hit"), "row", "left_anti").select(*names).toDF(*docs.columns)
