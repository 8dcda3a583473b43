"""Registered queries of the training-data operators and their DuckDB SQL.

The others have no SQL that runs on whole tables: tests/llm checks them against
brute force, the tokenizers library, or held-out accuracy.
"""

from __future__ import annotations

from tarmac.llm import (
    bpe, decontaminate, embedding_dedup, exact_dedup, hard_negatives, html_extract, jaccard_join, language_model,
    line_dedup, phrases, quality, sharding, suffix_dedup,
)

QUERIES = {
    "op1_jaccard_join": jaccard_join.op1_jaccard_join,
    "op2_html_extract": html_extract.op2_html_extract,
    "op3_bpe": bpe.op3_bpe,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_quality": quality.op6_quality,
    "op7_lm_score": language_model.op7_lm_score,
    "op8_suffix_dedup": suffix_dedup.op8_suffix_dedup,
    "op9_sharding": sharding.op9_sharding,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_embedding_near_dedup": embedding_dedup.op11_embedding_near_dedup,
    "op12_phrase_collocations": phrases.op12_phrase_collocations,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}

ORACLE_SQL = {
    "op5_decontaminate": decontaminate.ORACLE,
    "op7_lm_score": language_model.ORACLE,
    "op10_exact_dedup": exact_dedup.ORACLE,
    "op11_embedding_near_dedup": embedding_dedup.ORACLE,
    "op12_phrase_collocations": phrases.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}
