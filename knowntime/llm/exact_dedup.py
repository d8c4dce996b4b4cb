"""Exact dedup by two-pass Bloom filtering; DataFrame functions only.

Pass one hashes every text to two slots of a bit table and keeps the slots that
two or more rows hit. Pass two probes that table: a row with an unshared slot
cannot have a copy and passes straight through; the others are shuffled by
SHA-256 and grouped. A false positive costs one narrow shuffled row and changes
no result.

Scale: the text is read once and only (id, digest) goes on. In pass one no row is
shuffled: each task packs the slots that it saw into one array a block of the table, so
that tasks times blocks rows move, of four bytes a slot. The filter has 16 bits a row. Past
``max_bits`` the digests are dealt by a hash into ranges, written apart, and each range
has a filter of its own, one after the other, so that what is broadcast (a 64-bit word
with a shared slot, at most ``max_bits / 64`` of them) stays bounded and the filter
as selective. Digests that a sketch of frequent items names take the second path without
a filter, so that no array holds a hot group. Groups that hold over 1/256 of
the rows number at most 256: they are broadcast, and their rows never meet in
one task.

Edge cases: a null text counts as empty, an empty table gives an empty result,
and rows that agree in id and text are one document: each of them has the
same verdict, and :func:`drop_exact_duplicates` keeps the first of them. A null id
is below every other id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import attach
from .staging import drop, exists, new_path, numbered, stage, stage_at, tidy, write

BITS_A_ROW = 16
#: log2 of the slots in a block.
BLOCK = 18
#: Items and counters of the sketch of frequent digests.
FREQUENT, TRACKED = 1000, 10_000


def _filter_bits(rows: int, max_bits: int) -> int:
    bits = 1 << BLOCK
    while bits < BITS_A_ROW * rows and bits < max_bits:
        bits *= 2
    return bits


def frequent(digests: DataFrame) -> DataFrame:
    """(sha_hash, hot): at most FREQUENT hashes of digests, all those of over about 1/TRACKED of the rows among them."""
    top = digests.agg(F.call_function("approx_top_k", F.xxhash64("sha"), F.lit(FREQUENT), F.lit(TRACKED)).alias("top"))
    return top.select(F.explode("top").alias("t")).where("t.count > 1").select(F.col("t.item").alias("sha_hash"), F.lit(True).alias("hot"))


def repeated_slots(digests: DataFrame, slots: list[Column]) -> DataFrame:
    """(word, mask): the slots that at least two rows hit, 64 to a word."""
    each = digests.select(F.explode(F.array(*slots)).alias("slot"))
    packed = each.groupBy(F.shiftright("slot", BLOCK).alias("block")).agg(F.collect_list((F.col("slot") % (1 << BLOCK)).cast("int")).alias("seen"))
    # A block lies in one task by now, and so do its slots.
    hits = packed.select("block", F.explode("seen").alias("at")).groupBy("block", "at").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at") % 64)
    words = hits.groupBy("block", F.shiftright("at", 6).alias("nth")).agg(F.bit_or(one).alias("mask"))
    return words.select((F.col("block") * (1 << (BLOCK - 6)) + F.col("nth")).alias("word"), "mask")


def probe(rows: DataFrame, slots: list[Column], words: DataFrame) -> DataFrame:
    """Adds ``maybe``: every slot of the row is set in the filter."""
    hit = F.lit(True)
    for k, slot in enumerate(slots):
        side = words.select(F.col("word").alias(f"_word{k}"), F.col("mask").alias(f"_mask{k}"))
        rows = rows.join(F.broadcast(side), F.shiftright(slot, 6) == F.col(f"_word{k}"), "left")
        bit = F.call_function("shiftright", F.col(f"_mask{k}"), (slot % 64).cast("int")).bitwiseAND(F.lit(1).cast("long"))
        hit = hit & (F.coalesce(bit, F.lit(0).cast("long")) == 1)
    return rows.withColumn("maybe", hit).drop(*[f"_{x}{k}" for k in range(len(slots)) for x in ("word", "mask")])


def _probed(df: DataFrame, key: Column, text: Column, max_bits: int) -> tuple[DataFrame, int]:
    """(key, sha, maybe) of every row and their number: rows without ``maybe`` have no copy."""
    spark = df.sparkSession
    digests, path = stage_at(df.select(key.alias("key"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("sha")), "digests")
    rows = digests.count()
    ranges = max(1, -(-BITS_A_ROW * rows // max_bits))
    if ranges > 1:
        dealt = new_path(spark, "ranges")
        write(digests.withColumn("range", F.pmod(F.xxhash64(F.lit(2), "sha"), F.lit(ranges)).cast("int")), dealt, "range")
        drop(spark, path)
        path = dealt
    out = new_path(spark, "probed")
    for folder in [path] if ranges == 1 else [f"{path}/range={k}" for k in range(ranges)]:
        if not exists(spark, folder):
            continue
        part = spark.read.schema(digests.schema).parquet(folder)
        bits = _filter_bits(-(-rows // ranges), max_bits)
        slots = [F.pmod(F.xxhash64(F.lit(i), F.col("sha")), F.lit(bits)) for i in range(2)]
        hot, hot_path = stage_at(frequent(part), "frequent")
        part = part.withColumn("sha_hash", F.xxhash64("sha")).join(F.broadcast(hot), "sha_hash", "left").drop("sha_hash")
        filter_, filter_path = stage_at(repeated_slots(part.where("hot is null"), slots), "filter")
        write(probe(part, slots, filter_).select("key", "sha", (F.col("maybe") | F.col("hot").isNotNull()).alias("maybe")), out)
        drop(spark, hot_path, filter_path)
    drop(spark, path)
    schema = digests.select("key", "sha", F.lit(True).alias("maybe")).schema
    return spark.read.schema(schema).parquet(out), rows


@tidy
def exact_groups(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    normalise=lambda text: text, max_bits: int = 1 << 28,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    ``normalise`` maps the text column to what is compared. Of equal texts the
    row with the largest id stays.
    """
    probed, rows = _probed(df, F.col(id_col), normalise(F.coalesce(F.col(text_col), F.lit(""))), max_bits)
    alone = probed.where(~F.col("maybe")).select("key", "sha", F.col("key").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    maybe = probed.where("maybe").select("key", "sha")
    groups = stage(maybe.groupBy("sha").agg(F.max("key").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups")
    return alone.unionByName(attach(maybe, groups, "sha", "group_size", rows)).select(
        F.col("key").alias(id_col), "keep_id", "group_size", F.col("key").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


@tidy
def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise=lambda text: text, max_bits: int = 1 << 28) -> DataFrame:
    """One row of each group of equal texts, with all its columns: the one of the largest id, of equal ids the first."""
    names = [f"c{i}" for i in range(len(df.columns))]
    plain = numbered(df.toDF(*names), "row")
    key = F.struct(F.col(names[df.columns.index(id_col)]).alias("id"), (-F.col("row")).alias("row"))
    probed, rows = _probed(plain, key, normalise(F.coalesce(F.col(names[df.columns.index(text_col)]), F.lit(""))), max_bits)
    maybe = probed.where("maybe").select("key", "sha")
    groups = stage(maybe.groupBy("sha").agg(F.max("key").alias("keep"), F.count(F.lit(1)).alias("n")).where("n > 1"), "groups")
    gone = stage(attach(maybe, groups, "sha", "n", rows).where("key <> keep").select((-F.col("key.row")).alias("row")), "gone")
    return plain.join(gone, "row", "left_anti").select(*names).toDF(*df.columns)
