"""Queries of this subpackage by name, and the SQL that gives the same rows."""

from __future__ import annotations

import importlib

from pyspark.sql import DataFrame, SparkSession

#: Query name and the module that holds it.
MODULES = {
    "op1_quality_rules": "quality",
    "op2_mixing_weights": "mixing",
    "op3_ngram_jaccard_join": "ngram_join",
    "op4_toxicity": "toxicity",
    "op5_best_fit_packing": "packing",
    "op6_media_columns": "media",
    "op7_suffix_array_dedup": "suffix_dedup",
    "op8_token_counts": "token_counts",
    "op9_substring_dedup": "substring_dedup",
    "op10_html_extraction": "html_text",
}


def _query(name: str, module: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(importlib.import_module(f"{__package__}.{module}"), name)(spark, sf_dir)

    run.__name__ = name
    return run


def queries() -> dict:
    return {name: _query(name, module) for name, module in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    from .oracles import ORACLES

    return dict(ORACLES)
