import hashlib
import random

from knowntime.llm import substring_dedup, vectortext


def brute(rows, size):
    first = {}
    split = {i: (t or "").encode().split() for i, t in rows}
    for i in sorted(split):
        w = split[i]
        for p in range(len(w) - size + 1):
            first.setdefault(tuple(w[p : p + size]), i)
    out = {}
    for i, w in split.items():
        gone = {q for p in range(len(w) - size + 1) if first[tuple(w[p : p + size])] < i for q in range(p, p + size)}
        out[i] = (len(w), len(gone), hashlib.sha256(b" ".join(x for q, x in enumerate(w) if q not in gone)).hexdigest())
    return out


def rows():
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(60)]
    passage = rng.choices(vocab, k=30)
    out = []
    for i in range(80):
        w = rng.choices(vocab, k=rng.randint(0, 150))
        if i % 2:
            at = rng.randint(0, len(w))
            w[at:at] = passage[rng.randint(0, 8) :] if i % 4 == 1 else passage
        out.append((i * 3, "  ".join(w)))
    out += [(500, out[7][1]), (501, out[7][1] + "\n"), (502, None), (503, ""), (504, "x " * 90), (505, "x " * 40), (506, "é " * 30)]
    return out


def test_same_as_brute_force(spark):
    data = rows()
    df = spark.createDataFrame([(i, t, "z") for i, t in data], "doc_id long, text string, anchor string")
    for size, heavy in ((10, 2000), (10, 3), (7, 5)):
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.repeated_windows(df, size, heavy=heavy).collect()}
        assert got == brute(data, size)


def test_intervals_and_nulls(spark):
    df = spark.createDataFrame([(1, "a b c d e"), (2, "x a b c d y a b c d"), (None, "a b c d e")], "doc_id long, text string")
    got = {r.doc_id: ([tuple(s) for s in r.spans], r.kept_text) for r in substring_dedup.repeated_windows(df, 4).collect()}
    assert got == {1: ([], "a b c d e"), 2: ([(1, 5), (6, 10)], "x y"), None: ([], "a b c d e")}


def test_empty(spark):
    assert substring_dedup.repeated_windows(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_words_and_hashes():
    w = vectortext.words([b"a bb\ta", b"", b" bb ", b"a" * 500])
    assert (w.first.tolist(), w.doc.tolist()) == ([0, 3, 3, 4, 5], [0, 0, 0, 2, 3])
    assert w.hash[0] == w.hash[2] and w.hash[1] == w.hash[3] and w.hash[0] != w.hash[1]
    g = vectortext.grams(vectortext.words([b"a b c a b c"]).hash, 3)
    assert g[0] == g[3] and len(set(g.tolist())) == 3
    assert vectortext.sliding_min(g, 2).tolist() == [min(g[i : i + 2]) for i in range(3)]


def test_two_hashes_of_a_word_are_independent():
    from knowntime.llm.vectortext import rehash, words

    w = words([b"one two three one", b"\xc3\xa9t\xc3\xa9 one"])
    second = rehash(w, substring_dedup.SECOND)
    assert len(set(second.tolist())) == len(set(w.hash.tolist())) == 4 and not set(second.tolist()) & set(w.hash.tolist())
    assert second[0] == second[3] == second[5]
