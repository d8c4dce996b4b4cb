"""op7: SimHash components of ``documents``; checked against brute force, SQL has no XXH64."""

from pyspark.sql import functions as F

from .simhash import near_groups

SQL = None


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    hexed = F.lower(F.lpad(F.hex(F.get("fps", F.lit(0))), 16, "0")).alias("fingerprint")
    return near_groups(docs, shingle=4, distance=4).select("doc_id", hexed, "component_id")
