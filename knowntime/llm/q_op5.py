"""op5: tokens of every one of ``documents``, read back from flat token files."""

from .token_files import document_tokens

SQL = r"SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens FROM documents"


def query(spark, sf_dir):
    return document_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
