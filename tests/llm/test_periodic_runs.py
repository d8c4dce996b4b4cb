import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from knowntime.llm import periodic_runs, q_op12
from knowntime.llm.vectortext import mix


def brute(words, times=3, least=24):
    """{(start, length): smallest period} by trying every period everywhere."""
    n, out = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(least, times * q):
                out.setdefault((start, i - start + q), q)
            i += 1
    return sorted((s, length, q) for (s, length), q in out.items())


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def sequence(rng, n):
    kinds = rng.choice([1, 2, 3, 50])
    out = [rng.randrange(kinds) for _ in range(n)]
    for _ in range(rng.randint(0, 3) if n >= 10 else 0):
        a, p = rng.randrange(n), rng.randint(1, max(1, n // 5))
        for i in range(a + p, min(n, a + p * rng.randint(2, 6) + rng.randint(0, p))):
            out[i] = out[i - p]
    return out


def hashed(words):
    return mix(np.array(words, np.int64).astype(np.uint64) + np.uint64(7))


def test_whole_documents():
    rng = random.Random(1)
    for _ in range(150):
        docs = [sequence(rng, rng.choice([0, 1, 5, 23, 24, 25, 40, 100, 200])) for _ in range(rng.randint(1, 8))]
        first = np.concatenate(([0], np.cumsum([len(d) for d in docs]))).astype(int)
        got = [[] for _ in docs]
        for d, p, start, stop in zip(*periodic_runs.whole(hashed([x for d in docs for x in d]), first, 3, 24)):
            got[d].append((start, stop - start + p, p))
        assert [sorted(g) for g in got] == [brute(d) for d in docs]


@pytest.mark.parametrize("low", [2, 3, 4])
def test_tiles_and_their_borders(spark, monkeypatch, low):
    """Fragments of tiles, solved one by one, are stitched to the runs of the whole."""
    monkeypatch.setattr(periodic_runs, "LOW", low)
    rng, rows, want = random.Random(low), [], {}
    for row in range(40):
        words = sequence(rng, rng.choice([300, 700, 1500]))
        want[row] = brute(words)
        h = hashed(words)
        for a, b, at, own, part in periodic_runs.tiles(h, rng.choice([16, 40, 64]), 3):
            assert len(part) <= own + (2 << b)
            rows += [(row, int(p), int(s + at), int(e + at)) for p, s, e in zip(*periodic_runs.solve(part, a, b, own, at == 0, at + own >= len(h)))]
    got = {row: [] for row in want}
    rng.shuffle(rows)
    for r in periodic_runs.stitched(spark.createDataFrame(rows, "row long, period long, start long, stop long"), 3, 24).collect():
        got[r.row].append((r.start, r.length, r.period))
    assert {row: sorted(g) for row, g in got.items()} == want


def test_rows(spark):
    """Null, empty and long texts, one word over and over, repeated rows, null ids, clashing columns; long ones by tiles."""
    rng = random.Random(3)
    texts = [None, "", "  \n ", "a " * 23, "a " * 24, "a\tb " * 12, "A a " * 30, "x " * 3000 + "y", *[" ".join(f"w{x}" for x in sequence(rng, n)) for n in (30, 700, 9000, 9000)]]
    texts[-1] = " ".join([f"v{i}" for i in range(4100)] * 4 + ["end"])
    rows = [(None if i == 5 else i, t) for i, t in enumerate(texts)] + [(7, texts[7]), (4, "other")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("own") for c in ("row", "id", "runs", "found", "period", "n_words")})
    got = periodic_runs.periodic_runs(df, tile=2000)
    assert got.columns == ["doc_id", "n_words", "runs", "text"]
    want = []
    for i, t in rows:
        words = (t or "").split()
        # Brute force in C-sized steps for the long one, whose period is known.
        runs = [(0, 4 * 4100, 4100)] if words[-1:] == ["end"] else brute(words)
        want.append((str(i), len(words), runs, " ".join(collapsed(words, runs))))
    found = sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.text) for r in got.collect())
    assert found == sorted(want)
    assert sum(bool(r[2]) for r in found) >= 6
    assert periodic_runs.periodic_runs(df.limit(0)).count() == 0


def test_fewer_than_three_periods_are_refused(spark):
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(spark.createDataFrame([(1, "a")], "doc_id long, text string"), times=2)


def test_query_and_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    rows = {r.doc_id: r for r in q_op12.query(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        words, h = (r.text or "").split(), zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if len(words) > 1500:
            continue
        runs, got = brute(words), rows[r.doc_id]
        assert got.n_runs == len(runs)
        if runs:
            s, length, q = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]))
            assert (got.start, got.length, got.period, got.exponent_milli) == (s, length, q, 1000 * length // q)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert sorted(con.execute(q_op12.SQL).fetchall()) == sorted(map(tuple, rows.values()))
