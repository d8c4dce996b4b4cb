import random

import numpy as np
import pytest

from knowntime.llm import token_files


def test_blocks_are_stitched(spark, tmp_path):
    rng = random.Random(6)
    want = []
    for f in range(4):
        lengths = [rng.choice([0, 1, 2, 7, 40]) for _ in range(25)]
        tokens = np.concatenate([np.array([5] * n + [0], "<u4") for n in lengths])
        torn = f % 2 * 9
        (tmp_path / f"f{f}.tokens").write_bytes(np.concatenate([tokens, np.full(torn, 3, "<u4")]).tobytes())
        want += [(f"f{f}.tokens", i, n, True) for i, n in enumerate(lengths)] + ([(f"f{f}.tokens", 25, 9, False)] if torn else [])
    (tmp_path / "empty.tokens").write_bytes(b"")
    for block in (1, 3, 8, 1000):
        got = token_files.count_tokens(spark, f"file://{tmp_path}", block)
        assert sorted(map(tuple, got.collect())) == sorted(want)


def test_broken_file(spark, tmp_path):
    (tmp_path / "f.tokens").write_bytes(b"12345")
    with pytest.raises(Exception, match="no whole number"):
        token_files.count_tokens(spark, f"file://{tmp_path}")


def test_documents(spark):
    rows = [(i, "a b\tc\n" * (i % 7), "x") for i in range(50)] + [(50, None, "x"), (50, "q", "x"), (None, "", "x"), (52, "w " * 5000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, file string")
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens) for r in token_files.document_tokens(df, file_tokens=100).collect())
    assert got == sorted((-1 if i is None else i, len((t or "").split())) for i, t, _ in rows)
    assert token_files.document_tokens(df.limit(0)).count() == 0


def test_what_a_killed_task_leaves_is_not_read(spark, tmp_path):
    (tmp_path / "a.tokens").write_bytes(np.array([4, 4, 0], "<u4").tobytes())
    (tmp_path / "b.tokens.part").write_bytes(b"12345")
    assert [r.n_tokens for r in token_files.count_tokens(spark, f"file://{tmp_path}").collect()] == [2]
