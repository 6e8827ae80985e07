"""Queries of the corpus operators and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from importlib import import_module

_MODULES = {
    "op1_chat_format": "chat_format",
    "op2_suffix_dedup": "suffix_dedup",
    "op3_cotraining": "cotraining",
    "op4_exact_dedup": "exact_dedup",
    "op5_substring_dedup": "substring_dedup",
    "op6_toxicity": "toxicity",
    "op7_bpe": "bpe",
    "op8_ngram_jaccard": "ngram_jaccard",
    "op9_quality_rules": "quality_rules",
    "op10_best_fit_packing": "packing",
    "op11_periodic_runs": "periodic_runs",
    "op12_language_id": "language_id",
    "op13_ranked_search": "ranked_search",
}


def queries() -> dict:
    return {name: import_module(f"{__package__}.{module}").query for name, module in _MODULES.items()}


def oracle_sql() -> dict[str, str]:
    found = {name: getattr(import_module(f"{__package__}.{module}"), "SQL", None) for name, module in _MODULES.items()}
    return {name: sql for name, sql in found.items() if sql}
