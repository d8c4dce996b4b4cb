"""op2: word windows of ``documents`` that start in an earlier document too."""

from .substring_dedup import repeated_windows

SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS lo FROM win) WHERE doc_id > lo),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM later),
word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM d),
k AS (SELECT doc_id, count(gone.p) AS n_removed, string_agg(x, ' ' ORDER BY p) FILTER (WHERE gone.p IS NULL) AS kept FROM word LEFT JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return repeated_windows(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
