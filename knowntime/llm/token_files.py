"""Token counts from flat, unindexed token files.

A token file is a run of little-endian unsigned 32-bit ids; a document ends with
an end-of-document id and nothing else marks it. Files are cut into blocks of a
fixed number of tokens. Inside a block a vectorised comparison finds the end
marks; each block yields the lengths of the documents that end in it and the
tokens left open at its end. A prefix scan over the block summaries of a file
carries open tokens to the block where the document ends.

Scale: blocks are independent rows, and what is scanned is one summary a block.
A file is one read of ``binaryFile`` (2 GB at most); the writer starts a new file
after ``file_tokens`` tokens. A file that holds a third of all tokens is many
blocks; only their summaries meet, by file.

Edge cases: an empty file has no documents; tokens after the last mark form a
document with ``complete`` false; neighbouring marks are documents of length 0.
A null text has no tokens and still ends with a mark. A file whose size is no
multiple of four bytes raises an error. A file gets its name when it is complete, so what
a killed task leaves is never read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .staging import new_path, stage, tidy
from .vectortext import slabs, words

EOD = 0


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The plain tokenizer: a word's hash without the id of the mark; ids and tokens per text."""
    w = words(texts)
    return (w.hash % np.uint64(0xFFFFFFFF)).astype("<u4") + np.uint32(1), np.diff(w.first)


def _writer(folder: str, tokenize, file_tokens: int):
    def run(batches):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        out, name, held, at = None, None, 0, 0

        def close():
            out.close()
            store.move(f"{root}/{name}.part", f"{root}/{name}")

        for batch in batches:
            ids = batch.column(0)
            for a, b, texts in slabs(batch.column(1)):
                tokens, counts = tokenize(texts)
                marked = np.insert(tokens, np.cumsum(counts), np.uint32(EOD)).astype("<u4")
                if out is None or held > file_tokens:
                    if out is not None:
                        close()
                    # A name of its own for every attempt: only the rows of the attempt that counts name its files.
                    name, held, at = f"{uuid.uuid4().hex}.tokens", 0, 0
                    out = store.open_output_stream(f"{root}/{name}.part")
                out.write(marked.tobytes())
                held += len(marked)
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.array([name] * (b - a)), pa.array(np.arange(at, at + b - a), pa.int64())], ["id", "file", "ordinal"])
                at += b - a
        if out is not None:
            close()

    return run


def write_token_files(docs: DataFrame, folder: str, tokenize=hashed_words, file_tokens: int = 4_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files and return (id, file, ordinal): which document is the n-th of which file.

    ``folder`` is a URI that driver and executors share and pyarrow can write.
    """
    spark = docs.sparkSession
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = rows.select("id").schema.add("file", "string").add("ordinal", "long")
    return stage(rows.mapInArrow(_writer(folder, tokenize, file_tokens), schema), "manifest").withColumnRenamed("id", id_col)


def _blocks(block: int, eod: int):
    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                name, data = batch.column(0)[row].as_py(), batch.column(1)[row].as_buffer()
                if data.size % 4:
                    raise ValueError(f"{name}: {data.size} bytes are no whole number of tokens")
                tokens = np.frombuffer(data, "<u4")
                for k, a in enumerate(range(0, len(tokens), block)):
                    part = tokens[a : a + block]
                    marks = np.flatnonzero(part == eod)
                    lengths = np.diff(marks, prepend=-1) - 1
                    left = len(part) - 1 - (marks[-1] if len(marks) else -1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name]), pa.array([k], pa.int64()), pa.array([len(marks)], pa.int64()), pa.array([left], pa.int64()), pa.array([lengths], pa.list_(pa.int64()))],
                        ["file", "block", "marks", "left", "lengths"])

    return run


def count_tokens(spark: SparkSession, folder: str, block: int = 1 << 16, eod: int = EOD) -> DataFrame:
    """(file, ordinal, n_tokens, complete) of every document in the files of ``folder``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tokens").load(folder)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    found = stage(files.mapInArrow(_blocks(block, eod), "file string, block long, marks long, left long, lengths array<long>"), "blocks")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    scan = found.select("file", "block", "marks", "left").withColumn("seen", F.coalesce(F.sum("marks").over(before), F.lit(0)))
    # Blocks after the same mark are open together; a block with marks starts anew with what it leaves.
    group = Window.partitionBy("file", (F.col("seen") + F.col("marks")))
    open_before = F.sum("left").over(group.orderBy("block").rowsBetween(Window.unboundedPreceding, 0))
    scan = scan.withColumn("open", open_before).withColumn("carried", F.coalesce(F.lag("open").over(Window.partitionBy("file").orderBy("block")), F.lit(0)))
    lengths = found.select("file", "block", "lengths").join(scan.select("file", "block", "seen", "carried"), ["file", "block"])
    ended = lengths.select("file", "seen", "carried", F.posexplode("lengths").alias("i", "n")).select(
        "file", (F.col("seen") + F.col("i")).alias("ordinal"), (F.col("n") + F.when(F.col("i") == 0, F.col("carried")).otherwise(0)).alias("n_tokens"), F.lit(True).alias("complete"))
    last = scan.groupBy("file").agg(F.max_by(F.struct((F.col("seen") + F.col("marks")).alias("ordinal"), F.col("open").alias("n_tokens")), "block").alias("m"))
    torn = last.where("m.n_tokens > 0").select("file", "m.ordinal", "m.n_tokens", F.lit(False).alias("complete"))
    return ended.unionByName(torn)


@tidy
def document_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, n_tokens) of every document, by way of token files in the shared folder."""
    folder = new_path(docs.sparkSession, "tokens")
    manifest = write_token_files(docs, folder, id_col=id_col, text_col=text_col, **options)
    # Files of attempts that do not count are in no row of the manifest.
    counted = count_tokens(docs.sparkSession, folder)
    return manifest.join(counted, ["file", "ordinal"]).select(id_col, "n_tokens")
