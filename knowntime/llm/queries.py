"""The registered queries of this subpackage, one module each, and their SQL."""

from __future__ import annotations

import importlib

NAMES = [
    "op1_mixing",
    "op2_substring_dedup",
    "op3_quality",
    "op4_toxicity",
    "op5_token_counts",
    "op7_simhash",
    "op8_line_dedup",
    "op9_exact_dedup",
    "op10_lm_scoring",
    "op6_decontaminate",
    "op11_sentencepiece",
    "op12_periodic_runs",
    "op13_whitening",
]


def queries() -> dict:
    return {n: importlib.import_module(f"{__package__}.q_{n.split('_')[0]}").query for n in NAMES}


def oracle_sql() -> dict[str, str]:
    found = {n: importlib.import_module(f"{__package__}.q_{n.split('_')[0]}").SQL for n in NAMES}
    return {n: sql for n, sql in found.items() if sql}
