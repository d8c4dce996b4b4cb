"""The driver contract, with and without the training-data part."""

import importlib
import os
import sys

import pytest

SF = "/root/testdata/sf0.001"


def test_every_sql_has_a_query():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.oracle_sql()) > 70


def test_imports_without_llm(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("knowntime.llm") or m in ("corpus_pipeline", "__spark_entry__")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "knowntime.llm", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    e = importlib.import_module("__spark_entry__")
    assert "f1_valuations" in e.queries() and not any(q.startswith("op") for q in e.queries())
    monkeypatch.delitem(sys.modules, "__spark_entry__")


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).limit(5).count() == 5
