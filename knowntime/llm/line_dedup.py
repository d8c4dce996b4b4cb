"""Line dedup with a suffix array over line sequences; DataFrame functions only.

Every document is a sequence of its non-blank lines. The suffix array of all
sequences is built by prefix doubling: suffixes are ranked by their first line,
then by 2, 4, 8, ... lines, each round ranking the pairs (rank here, rank h
lines on) with a distributed sort. A line that occurs once ends every repeat,
so only suffixes that begin with a repeated line are ranked, and only those
whose class still has two members take part in the next round. Neighbours in
the array get their longest common prefix from the stored rounds, by binary
descent. Suffixes between drops of that prefix below ``min_lines`` form an
interval: all of them begin with the same run of lines. The first by
(id, position) stays, and the run is deleted from each later one.

Scale: after the first count the work follows the number of repeated lines, not
of lines; rounds are logarithmic in the longest repeated run. Ranks come from
range partitions whose totals are stitched, hot lines are broadcast as groups,
and each round is written to the shared folder.

A single line that repeats is a run too, but many short lines repeat by chance:
alone, only lines of ``alone_chars`` characters or more are cut.

Edge cases: a line of spaces only is blank, blank lines are no lines of the sequence
and stay where they are; a null text stays null and an empty table gives an empty
result. A document is its id and its text: rows that agree in both lose the same
lines, rows that share only the id are told apart, in the order of a hash of the
text. A null id is an id of its own, below all others. Columns keep their names,
whatever they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import attach, running_total
from .staging import drop, stage, stage_at, tidy


def document_of(id_col: str, text_col: str) -> Column:
    """What tells documents apart, in the order in which copies are later ones."""
    text = F.col(text_col)
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def lines_of(df: DataFrame, id_col: str, text_col: str, alone_chars: int = 0) -> DataFrame:
    """(doc, seq, line, key): the non-blank lines, numbered; key is a 128-bit hash and whether the line counts alone."""
    parts = F.transform(F.split(F.col(text_col), "\n"), lambda x, i: F.struct(i.alias("line"), x.alias("text")))
    filled = F.filter(parts, lambda p: F.trim(p["text"]) != "")
    rows = df.select(document_of(id_col, text_col).alias("doc"), F.posexplode(filled).alias("seq", "part"))
    text = F.col("part.text")
    key = F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"), (F.char_length(text) >= alone_chars).alias("alone"))
    return rows.groupBy("doc", "seq").agg(F.min(F.struct(F.col("part.line").alias("line"), key.alias("key"))).alias("m")).select("doc", "seq", "m.line", "m.key")


def suffix_array(lines: DataFrame) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """The repeated suffixes with their place ``sa``, the classes after 1, 2, 4, ... lines, and the repeated lines.

    A class table has (doc, seq, rank) of the suffixes that share that many
    lines with another one; equal ranks mean equal lines.
    """
    spark, total = lines.sparkSession, lines.count()
    groups = lines.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    ranks = running_total(groups, ["key"], F.col("size"), "rank", "rank0").select("key", "size", (F.col("rank") + 1).alias("rank"))
    ranks, path = stage_at(ranks, "ranks")
    firsts = stage(attach(lines.select("doc", "seq", "key"), ranks, "key", "size", total).select("doc", "seq", "rank", "size", F.col("key.alone").alias("alone")), "suffixes")
    drop(spark, path)
    ranked, levels, reach = firsts.drop("alone"), [], 1
    while True:
        active = ranked.where("size > 1")
        if active.isEmpty():
            break
        levels.append(active.select("doc", "seq", "rank"))
        ahead = ranked.select("doc", (F.col("seq") - reach).alias("seq"), F.col("rank").alias("next"))
        # Nothing that repeats follows: no other suffix goes on alike. The number is fixed when the pairs are written.
        alone = -1 - F.monotonically_increasing_id()
        pairs, at_pairs = stage_at(active.select("doc", "seq", "rank").join(ahead, ["doc", "seq"], "left").withColumn("next", F.coalesce("next", alone)), "pairs")
        groups = pairs.groupBy("rank", "next").agg(F.count(F.lit(1)).alias("n"))
        placed, at_placed = stage_at(running_total(groups, ["rank", "next"], F.col("n"), "before", "order"), "placed")
        start = placed.groupBy("rank").agg(F.min("before").alias("first"))
        renamed, at_renamed = stage_at(placed.join(start, "rank").select(
            F.struct("rank", "next").alias("pair"), (F.col("rank") + F.col("before") - F.col("first")).alias("to"),
            F.col("n").alias("size"), "n"), "renamed")
        moved = attach(pairs.select("doc", "seq", F.struct("rank", "next").alias("pair")), renamed, "pair", "n", total)
        done = ranked.where("size = 1")
        ranked = stage(done.unionByName(moved.select("doc", "seq", F.col("to").alias("rank"), "size")), "suffixes")
        drop(spark, at_pairs, at_placed, at_renamed)
        reach *= 2
    order = running_total(ranked.select("rank", "doc", "seq"), ["rank", "doc", "seq"], F.lit(1), "sa", "sa")
    return stage(order.select("doc", "seq", "sa"), "array"), levels, firsts


def common_prefixes(array: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """Adds ``lcp``: how many lines a suffix shares with the one before it in the array."""
    before = array.select((F.col("sa") + 1).alias("sa"), F.col("doc").alias("doc2"), F.col("seq").alias("seq2"))
    pairs, old = array.join(before, "sa", "left").withColumn("lcp", F.lit(0)), []
    for k in reversed(range(len(levels))):
        here = levels[k].select("doc", F.col("seq").alias("at"), F.col("rank").alias("r1"))
        there = levels[k].select(F.col("doc").alias("doc2"), F.col("seq").alias("at2"), F.col("rank").alias("r2"))
        pairs = pairs.withColumn("at", F.col("seq") + F.col("lcp")).join(here, ["doc", "at"], "left")
        pairs = pairs.withColumn("at2", F.col("seq2") + F.col("lcp")).join(there, ["doc2", "at2"], "left")
        same = F.coalesce(F.col("r1") == F.col("r2"), F.lit(False))
        pairs, path = stage_at(pairs.withColumn("lcp", F.col("lcp") + F.when(same, 1 << k).otherwise(0)).select("doc", "seq", "sa", "doc2", "seq2", "lcp"), "lcp")
        drop(array.sparkSession, *old)
        old = [path]
    return pairs.select("doc", "seq", "sa", "lcp")


def later_copies(prefixes: DataFrame, min_lines: int) -> DataFrame:
    """(doc, seq): suffixes that begin with ``min_lines`` lines of an earlier one."""
    # A suffix joins the interval of the one before it unless their prefix is too short.
    cut = running_total(prefixes, ["sa"], (F.col("lcp") < min_lines).cast("int"), "island", "cuts")
    cut = cut.withColumn("island", F.col("island") + (F.col("lcp") < min_lines).cast("int"))
    return _not_first(cut.select("island", "doc", "seq"), "island")


def _not_first(members: DataFrame, group: str) -> DataFrame:
    """(doc, seq) of every member of a group but the first by (document, position)."""
    members = stage(members.select(group, F.struct("doc", "seq").alias("at")), "members")
    firsts = stage(members.groupBy(group).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"), "firsts")
    return attach(members, firsts, group, "n", members.count()).where("at <> first").select("at.doc", "at.seq")


@tidy
def repeated_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, seq, lines): the longest run from each line on that occurs elsewhere too."""
    array, levels, _ = suffix_array(stage(lines_of(df, id_col, text_col), "lines"))
    lcp = stage(common_prefixes(array, levels), "prefixes")
    after = lcp.select((F.col("sa") - 1).alias("sa"), F.col("lcp").alias("next"))
    runs = lcp.join(after, "sa", "left").select(F.col("doc.id").alias(id_col), "seq", F.greatest("lcp", F.coalesce("next", F.lit(0))).alias("lines"))
    return runs.where("lines > 0")


@tidy
def drop_repeated_lines(
    df: DataFrame, min_lines: int = 2, alone_chars: int = 20, id_col: str = "doc_id", text_col: str = "text", removed_col: str | None = None,
) -> DataFrame:
    """``df`` with later copies of runs of ``min_lines`` or more lines, and of long single lines, cut from the text.

    ``removed_col`` names an added column with the number of lines cut.
    """
    lines = stage(lines_of(df, id_col, text_col, alone_chars), "lines")
    array, levels, firsts = suffix_array(lines)
    later = later_copies(stage(common_prefixes(array, levels), "prefixes"), min_lines)
    gone = later.select("doc", F.explode(F.sequence("seq", F.col("seq") + min_lines - 1)).alias("seq"))
    gone = gone.unionByName(_not_first(firsts.where("alone").select("rank", "doc", "seq"), "rank")).distinct()
    cut = stage(lines.join(gone, ["doc", "seq"], "left_semi").groupBy("doc").agg(F.collect_set("line").alias("cut")), "cut")
    # Plain names, whatever the columns are called; the text is split once, below the join.
    names = [f"c{i}" for i in range(len(df.columns))]
    text = names[df.columns.index(text_col)]
    rows = df.toDF(*names).withColumn("doc", document_of(names[df.columns.index(id_col)], text)).withColumn(text, F.split(text, "\n"))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(text) - 1), "cut"), lambda i: F.get(F.col(text), i))
    out = rows.join(cut, rows["doc"] == cut["doc"], "left").withColumn(text, F.array_join(F.when(F.col("cut").isNull(), F.col(text)).otherwise(kept), "\n"))
    added = [F.coalesce(F.size("cut"), F.lit(0)).alias("removed")] if removed_col else []
    return out.select(*names, *added).toDF(*df.columns, *([removed_col] if removed_col else []))
