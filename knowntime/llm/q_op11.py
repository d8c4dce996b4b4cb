"""op11: ``documents`` encoded and decoded with a public vocabulary; checked against the library, SQL cannot merge."""

from pyspark.sql import functions as F

from .piece_codec import decoded, encoded

SQL = None
MODEL = "piece_bpe_32k.model"


def query(spark, sf_dir, model=None):
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path(MODEL)
    ids = encoded(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), model)
    return decoded(spark, ids, model).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))
