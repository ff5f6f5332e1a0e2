"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weftline.llm import embedding_dedup, exact_dedup, fill_in_middle, html_text, language_model, mixing, ngram_join, packing, pii, quality, token_alignment, token_files, toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mixing": mixing.op1_mixing,
        "op2_packing": packing.op2_packing,
        "op3_ngram_join": ngram_join.op3_ngram_join,
        "op4_pii": pii.op4_pii,
        "op5_toxicity": toxicity.op5_toxicity,
        "op6_quality": quality.op6_quality,
        "op7_embedding_dedup": embedding_dedup.op7_embedding_dedup,
        "op8_exact_dedup": exact_dedup.op8_exact_dedup,
        "op9_language_model": language_model.op9_language_model,
        "op10_html_text": html_text.op10_html_text,
        "op11_fill_in_middle": fill_in_middle.op11_fill_in_middle,
        "op12_token_files": token_files.op12_token_files,
        "op13_token_alignment": token_alignment.op13_token_alignment,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": mixing.ORACLE, "op8_exact_dedup": exact_dedup.ORACLE, "op11_fill_in_middle": fill_in_middle.ORACLE}
