"""The registered queries of this subpackage, and SQL for the same rows where SQL can express them."""

from __future__ import annotations

from importlib import import_module

#: Modules with a query of the same name each, and ORACLE where there is one.
NAMES = [
    "op1_ngram_join",
    "op2_lm_scoring",
    "op3_license_scan",
    "op4_suffix_dedup",
    "op5_decontamination",
    "op6_sentencepiece",
    "op7_quality_rules",
    "op8_token_counts",
    "op9_language_id",
    "op10_line_dedup",
    "op11_fill_middle",
    "op12_collocations",
    "op13_simhash",
]


def queries() -> dict:
    return {"pipeline": import_module("corpus_pipeline").run} | {n: getattr(import_module(f"folio.llm.{n}"), n) for n in NAMES}


def oracle_sql() -> dict:
    found = {n: getattr(import_module(f"folio.llm.{n}"), "ORACLE", None) for n in NAMES}
    found["pipeline"] = import_module("corpus_pipeline").ORACLE_SQL
    return {n: sql for n, sql in found.items() if sql}
