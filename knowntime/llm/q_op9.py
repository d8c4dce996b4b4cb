"""op9: exact copies in ``documents``."""

from .exact_dedup import exact_groups

SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def query(spark, sf_dir):
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
