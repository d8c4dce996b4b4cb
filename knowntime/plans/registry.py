"""Queries over the driver tables, by name, with independent SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

MODULES = ["scalar_queries", "pit_queries", "sequence_queries", "fundamental_queries", "portfolio_queries", "store_queries", "source_queries", "report_queries"]
_QUERIES: dict[str, Callable] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (spark, sf_dir) under ``name``, with SQL that gives the same rows."""
    def add(function):
        _QUERIES[name] = function
        if sql:
            _SQL[name] = sql
        return function

    return add


def _load() -> None:
    for module in MODULES:
        importlib.import_module(f"{__package__}.{module}")


def queries() -> dict[str, Callable]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
