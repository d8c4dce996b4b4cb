"""op4: toxicity of ``documents``, learnt from four fifths of the labels; checked by held-out accuracy."""

from pyspark.sql import functions as F

from .toxicity import toxicity_scores

SQL = None


def fifth(column):
    return F.crc32(F.col(column).cast("string").cast("binary")) % 5


def query(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity_scores(docs, labels, train=fifth("_id") != 0)
    return scored.select("doc_id", F.coalesce(fifth("doc_id") == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
