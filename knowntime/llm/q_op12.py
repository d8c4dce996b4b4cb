"""op12: periodic runs of words in ``documents``, some of which are made periodic here."""

from pyspark.sql import functions as F

from .periodic_runs import periodic_runs

SQL = r"""
WITH split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS own, CAST(doc_id AS VARCHAR) AS digits FROM documents
), hashed AS (
  SELECT doc_id, own, len(own) AS n,
         xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, len(digits) + 1), lambda i: CAST(ascii(digits[i]) AS BIGINT))),
             lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) AS h
  FROM split
), planned AS (
  SELECT doc_id, own, n, h, h // 10 AS g, (h // 10) % greatest(n, 1) AS a FROM hashed
), texts AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: own[1 + CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // (3 + g % 8)) ELSE i END]) ELSE own END AS words
  FROM planned
), grams AS (
  SELECT doc_id, n, i, array_to_string(words[i + 1 : i + 8], ' ') AS gram FROM (SELECT doc_id, n, words, unnest(range(n - 7)) AS i FROM texts WHERE n >= 24)
), matches AS (
  SELECT a.doc_id, b.i - a.i AS q, a.i FROM grams a JOIN grams b ON a.doc_id = b.doc_id AND a.gram = b.gram AND b.i > a.i AND 3 * (b.i - a.i) <= a.n
), stretches AS (
  SELECT doc_id, q, min(i) AS start, count(*) + 7 + q AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS part FROM matches) GROUP BY doc_id, q, part
), runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretches WHERE length >= greatest(24, 3 * q) GROUP BY doc_id, start, length
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) AS place,
         string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) OVER (PARTITION BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS listed,
         count(*) OVER (PARTITION BY doc_id) AS n_runs
  FROM runs
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
  SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.i) AS text
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(n)) AS i FROM texts) w ANTI JOIN gone USING (doc_id, i) GROUP BY w.doc_id
)
SELECT t.doc_id, coalesce(r.n_runs, 0) AS n_runs, r.start, r.length, r.period, 1000 * r.length // r.period AS exponent_milli,
       sha256(coalesce(r.listed, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM texts t LEFT JOIN (SELECT * FROM ranked WHERE place = 1) r USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""


def planted(docs):
    """``documents`` of which every tenth, by the CRC of its id, goes on with a period of its own from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")

    def periodic(w):
        n, g = F.size(w).cast("long"), F.floor(h / 10)
        a = g % n
        return F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, (a + (i - a) % (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)))).cast("int"))))

    # The words are an element here, so that they are split once and not for each of them.
    text = F.array_join(F.get(F.transform(F.array(words), periodic), F.lit(0)), " ")
    return docs.select("doc_id", F.when((h % 10 == 0) & (F.size(words) > 0), text).otherwise(F.col("text")).alias("text"))


def query(spark, sf_dir):
    found = periodic_runs(planted(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    more = lambda x, y: x["length"] * y["period"] > y["length"] * x["period"]
    # Runs are in order of start and period: the first of the greatest exponent.
    best = F.reduce(F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))), F.get("runs", F.lit(0)), lambda x, y: F.when(more(y, x), y).otherwise(x))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    best = found.select("*", best.alias("best"))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"))
