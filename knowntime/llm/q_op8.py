"""op8: later copies of runs of two or more lines, and of single lines of 20 or more characters, in ``documents``."""

from pyspark.sql import functions as F

from .line_dedup import drop_repeated_lines

SQL = r"""
WITH l AS (SELECT doc_id, unnest(range(len(ls))) AS line, unnest(ls) AS t FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
s AS (SELECT doc_id, line, t, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS seq FROM l WHERE trim(t) <> ''),
w AS (SELECT doc_id, seq, t || chr(10) || lead(t) OVER (PARTITION BY doc_id ORDER BY seq) AS two FROM s),
c AS (SELECT doc_id, seq, row_number() OVER (PARTITION BY two ORDER BY doc_id, seq) AS nth FROM w WHERE two IS NOT NULL),
one AS (SELECT doc_id, seq, row_number() OVER (PARTITION BY t ORDER BY doc_id, seq) AS nth FROM s WHERE length(t) >= 20),
gone AS (SELECT doc_id, unnest([seq, seq + 1]) AS seq FROM c WHERE nth > 1 UNION SELECT doc_id, seq FROM one WHERE nth > 1),
k AS (SELECT l.doc_id, l.line, l.t, s.seq, gone.seq AS cut FROM l LEFT JOIN s USING (doc_id, line) LEFT JOIN gone ON s.doc_id = gone.doc_id AND s.seq = gone.seq)
SELECT d.doc_id, count(k.seq)::BIGINT AS n_lines, count(k.cut)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(k.t, chr(10) ORDER BY k.line) FILTER (WHERE k.cut IS NULL), '')) AS kept_sha256
FROM documents d LEFT JOIN k USING (doc_id) GROUP BY d.doc_id
"""


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    n = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.trim(x) != "")).cast("long")
    cut = drop_repeated_lines(docs.select("doc_id", "text"), removed_col="n_removed")
    n_removed = F.col("n_removed").cast("long")
    return cut.select("doc_id", (n + n_removed).alias("n_lines"), n_removed.alias("n_removed"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
