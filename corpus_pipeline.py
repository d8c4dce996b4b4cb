"""A training corpus from ``documents``: five stages, each a Parquet table that the next one reads.

toxicity: documents scored 0.5 or more go. line dedup: later copies of runs of two or
more lines, and of single lines of 20 characters or more, are cut from the texts.
SimHash near-dedup: of documents that SimHash finds and that share 0.8 of their
five-word shingles, directly or through others, the one with the smallest id stays.
benchmark decontamination: documents that hold a window of a benchmark item go.
mixing: the remaining documents, each as often as the mix of sources takes it.

Edge cases, the same in every stage: a null text is an empty one (line dedup leaves it
null) and so is kept unless it is a copy; a text may be of any length and is read whole;
ids may repeat or be null, as rows are decided by a row number of their own (line
dedup: by id and text); further columns are carried along, whatever they are called;
an empty table gives an empty table. Of ties the smallest id stays, then the first row.
Texts emptied by line dedup are copies of each other.

Models and drawn samples are not SQL, so ``ORACLE_SQL`` is None and the stages
are checked against brute force in tests/llm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knowntime.llm.decontaminate import decontaminate
from knowntime.llm.line_dedup import drop_repeated_lines
from knowntime.llm.mixing import mixed
from knowntime.llm.near_dedup import drop_similar
from knowntime.llm.staging import stage_step, step
from knowntime.llm.toxicity import drop_toxic

ORACLE_SQL = None


@step
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@step
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = drop_repeated_lines(docs)
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


@step
def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_similar(docs, similarity=0.8, shingle=5)


@step
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@step
def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage_step(function(spark, docs, sf_dir), name.split()[0].lower())
    return docs
