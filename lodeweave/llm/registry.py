"""The queries of this package by name, and SQL for those that SQL can express."""

from __future__ import annotations

from importlib import import_module

#: name: (module, name of its SQL or None)
_QUERIES = {
    "op1_warc_revisits": ("warc", "OP1_SQL"),
    "op2_token_counts": ("tokens", None),
    "op3_suffix_dedup": ("repeats", None),
    "op4_quality_rules": ("quality", "OP4_SQL"),
    "op5_lattice_scores": ("lattice", None),
    "op6_source_mixing": ("mixing", "OP6_SQL"),
    "op7_personal_data": ("pii", None),
    "op8_quality_classifier": ("classify", None),
    "op9_decontamination": ("tiling", None),
    "op10_simhash": ("simhash", None),
}


def queries() -> dict:
    return {name: getattr(import_module(f"lodeweave.llm.{module}"), name) for name, (module, _) in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: getattr(import_module(f"lodeweave.llm.{module}"), sql) for name, (module, sql) in _QUERIES.items() if sql}
