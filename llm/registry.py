"""Queries and SQL of this package, by the names under which __spark_entry__.py registers them."""

from __future__ import annotations

from llm import op10_warc, op11_periodic_runs, op12_centroids, op13_exact_dedup, op1_nn_descent, op2_mixing, op3_bpe, op4_ngram_jaccard, op5_quality_rules, op6_token_output, op7_language_id, op8_suffix_dedup, op9_substring_dedup

MODULES = {
    "op1_nn_descent": op1_nn_descent,
    "op2_mixing": op2_mixing,
    "op3_bpe": op3_bpe,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_quality_rules": op5_quality_rules,
    "op6_token_output": op6_token_output,
    "op7_language_id": op7_language_id,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_warc": op10_warc,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_centroids": op12_centroids,
    "op13_exact_dedup": op13_exact_dedup,
}


def queries() -> dict:
    return {name: module.query for name, module in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: module.ORACLE_SQL for name, module in MODULES.items() if getattr(module, "ORACLE_SQL", None)}
