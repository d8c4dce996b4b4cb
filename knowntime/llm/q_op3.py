"""op3: weak quality labels and scores of ``documents``; checked by agreement with held-back labels."""

from .weak_labels import quality_scores

SQL = None


def query(spark, sf_dir):
    return quality_scores(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "votes", "posterior", "score", "keep")
