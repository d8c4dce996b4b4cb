"""Exact dedup, decontamination and line dedup against brute force."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from knowntime.llm import decontaminate, exact_dedup, line_dedup


def test_exact_dedup(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["", "a", "A", "hot", "hot", "hot", f"only {i}"]), "x") for i in range(400)] + [(400, None, "x"), (None, "a", "x"), (5, "again", "x"), (5, "again", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(t or "", []).append(i)
    want = []
    for i, t, _ in rows:
        g = groups[t or ""]
        keep = max((x for x in g if x is not None), default=None)
        want.append((i, keep, len(g), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    # One filter, and four by ranges of a hash.
    for bits in (1 << 28, 1 << 11):
        got = [tuple(r) for r in exact_dedup.exact_groups(df, max_bits=bits).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    kept = exact_dedup.drop_exact_duplicates(df)
    assert kept.columns == df.columns and kept.where("text = 'hot'").count() == 1
    assert exact_dedup.exact_groups(df.limit(0)).count() == 0


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))


def contaminated(docs, items, span):
    wins = {}
    for item, t in items:
        w = words(t)
        n = min(span, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            wins.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = {}
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for win, ids in wins.items():
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i : i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    found |= ids
        out[d] = (len(w), len(hit), sorted(found))
    return out


def test_decontaminate(spark):
    rng = random.Random(2)
    vocab = ["Alpha", "beta", "GAMMA", "é", "É", "x1", "to", "of"]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([3, 5, 8, 9, 12])))) for i in range(12)] + [(12, None), (13, " ,;"), (14, "alpha beta gamma x1 to of é beta"), (15, "alpha beta gamma x1 to of é beta")]
    docs = [(i, rng.choice([" ", ", ", "--", "\x00"]).join(rng.choices(vocab, k=rng.randint(0, 60)))) for i in range(60)]
    docs += [(100, "say: " + items[4][1] + "! " + items[14][1].upper().replace("É", "é")), (101, None), (102, ""), (103, "A")]
    d = spark.createDataFrame([(i, t, "z") for i, t in docs], "doc_id long, text string, item string")
    b = spark.createDataFrame(items, "item_id long, text string")
    for span, k, limit in ((8, 4, 10**6), (8, 4, 0), (3, 3, 10**6)):
        got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontaminate.contaminated_words(d, b, span, k, max_broadcast=limit).collect()}
        assert got == contaminated(docs, items, span)
    clean = decontaminate.decontaminate(d, b, span=8)
    assert clean.columns == d.columns and clean.where("doc_id = 100").count() == 0 and clean.where("doc_id in (101, 102)").count() == 2
    assert decontaminate.contaminated_words(d.limit(0), b).count() == 0
    assert decontaminate.contaminated_words(d, b.limit(0)).where("n_hit > 0").count() == 0


def test_many_fingerprints_of_long_texts(spark):
    """Without any broadcast a long text is shuffled in proportion to its words, and every row has its own verdict."""
    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(5000)]
    texts = [" ".join(rng.choices(vocab, k=n)) for n in (1000, 100_000, 20, 60)]
    items = [(i, " ".join(texts[1].split()[a : a + 14])) for i, a in enumerate((0, 50_000, 99_986))] + [(9, texts[2])]
    rows = [(1, texts[0]), (1, texts[1]), (None, texts[2]), (None, texts[3]), (4, texts[2]), (4, texts[2]), (5, None)]
    df, b = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    # Names that would clash with the columns inside.
    df = df.withColumns({c: F.lit("own") for c in ("id", "own", "start", "fp", "at", "window")})
    shuffled = lambda: spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()
    before = {}
    for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        before[c] = spark.conf.get(c, None)
        spark.conf.set(c, "-1")
    try:
        start = shuffled()
        got = [(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in decontaminate.contaminated_words(df, b, max_broadcast=0).collect()]
        moved = shuffled() - start
    finally:
        for c, v in before.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)
    want = [(1, 1000, 0, []), (1, 100_000, 42, ["0", "1", "2"]), (None, 20, 20, ["9"]), (None, 60, 0, []), (4, 20, 20, ["9"]), (4, 20, 20, ["9"]), (5, 0, 0, [])]
    assert sorted(map(str, got)) == sorted(map(str, want))
    # 100,000 windows of about 30 bytes, and the text once.
    assert moved < 12 << 20


def test_exact_rows_that_share_an_id(spark):
    rows = [(1, "same", "a"), (5, "same", "b"), (5, "unlike", "c"), (None, "same", "d"), (None, "other", "e"), (7, "twice", "f"), (7, "twice", "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _gone string")
    got = exact_dedup.drop_exact_duplicates(df)
    assert got.columns == df.columns and sorted(r._gone for r in got.collect()) == ["b", "c", "e", "f"]


def test_long_texts(spark):
    text = "\n".join(f"line {i} of a long text of its own" for i in range(20000))
    rows = [(1, text), (2, text), (3, "line 5 of a long text of its own\nand a new one")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [(r.doc_id, r.keep_id) for r in exact_dedup.exact_groups(df).orderBy("doc_id").collect()] == [(1, 2), (2, 2), (3, 3)]
    assert [(r.doc_id, r.text) for r in line_dedup.drop_repeated_lines(df).orderBy("doc_id").collect()] == [(1, text), (2, ""), (3, "and a new one")]
    items = spark.createDataFrame([(1, "line 7 of a long text of its own line 8 of")], "item_id long, text string")
    assert [r.doc_id for r in decontaminate.decontaminate(df, items).collect()] == [3]


def without_repeats(docs, least, alone=20):
    """``docs`` are (id, text) in the order of ids."""
    seqs = [[(k, x) for k, x in enumerate(t.split("\n")) if x.strip(" ")] if t is not None else [] for _, t in docs]
    out = []
    cut = [set() for _ in docs]
    for n in {1, least}:
        first = {}
        for i, seq in enumerate(seqs):
            for p in range(len(seq) - n + 1):
                run = tuple(x for _, x in seq[p : p + n])
                if n == least or len(run[0]) >= alone:
                    if first.setdefault(run, (i, p)) != (i, p):
                        cut[i] |= {k for k, _ in seq[p : p + n]}
    for (_, t), gone in zip(docs, cut):
        out.append(None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone))
    return out


def test_line_dedup(spark):
    rng = random.Random(3)
    lines = [f"line {i}" for i in range(12)] + ["a line of some twenty characters", "another one of at least twenty"]
    docs = [(i, "\n".join(rng.choices([*lines, "", "hot", "hot", "\t"], k=rng.randint(1, 25)))) for i in range(40)] + [(50, None), (51, ""), (52, "hot\n" * 40), (53, "solo\n\nother")]
    docs += [(60, docs[3][1]), (61, docs[3][1])]
    df = spark.createDataFrame([(i, t, "z") for i, t in docs], "doc_id long, text string, line string")
    for least, alone in ((2, 20), (3, 20), (2, 1)):
        got = {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(df, least, alone).collect()}
        assert got == dict(zip([i for i, _ in docs], without_repeats(docs, least, alone)))
    assert line_dedup.drop_repeated_lines(df).columns == df.columns
    assert line_dedup.drop_repeated_lines(df.limit(0)).count() == 0


def test_lines_of_rows_that_share_an_id(spark):
    rows = [(1, "a,b,c", "x"), (5, "a,b,z", "y"), (5, "p,q,r", "z"), (None, "k,l", "w"), (None, "m,n", "v"), (9, "p,q,s", "u")]
    df = spark.createDataFrame([(i, t.replace(",", "\n"), k) for i, t, k in rows], "doc_id long, text string, _cut string")
    got = line_dedup.drop_repeated_lines(df, removed_col="n")
    assert got.columns == [*df.columns, "n"]
    assert {(r._cut, r.text, r.n) for r in got.collect()} == {("x", "a\nb\nc", 0), ("y", "z", 2), ("z", "p\nq\nr", 0), ("w", "k\nl", 0), ("v", "m\nn", 0), ("u", "s", 2)}
    twice = df.where("doc_id = 1").union(df.where("doc_id = 1"))
    assert [r.text for r in line_dedup.drop_repeated_lines(twice).collect()] == ["a\nb\nc"] * 2


def test_longest_repeats(spark):
    docs = [(1, "a\nb\nc\nd"), (2, "x\nb\nc\nd\ny"), (3, "c\nd\na"), (4, "a\na\na")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    seq = {i: t.split("\n") for i, t in docs}
    want = {}
    for i, s in seq.items():
        for p in range(len(s)):
            best = 0
            for j, t in seq.items():
                for q in range(len(t)):
                    if (i, p) != (j, q):
                        n = 0
                        while p + n < len(s) and q + n < len(t) and s[p + n] == t[q + n]:
                            n += 1
                        best = max(best, n)
            if best:
                want[i, p] = best
    assert {(r.doc_id, r.seq): r["lines"] for r in line_dedup.repeated_runs(df).collect()} == want
