"""op1: a mix of all of ``documents``; a drawn sample, so checked against its own constraints."""

from .mixing import mix_sources

SQL = None


def query(spark, sf_dir):
    return mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken", "copies")
