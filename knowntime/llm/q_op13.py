"""op13: ``embeddings`` whitened along their four main components; checked in high precision, SQL has no eigenvectors."""

from pyspark.sql import functions as F

from .whitening import whiten

SQL = None


def query(spark, sf_dir):
    found = whiten(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    each = found.select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "c"))
    return each.select("vec_id", (F.col("place") + 1).alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error")
