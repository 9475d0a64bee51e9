"""Queries of the text operators, and the SQL twins of those SQL can express."""

from __future__ import annotations

from ledgerline.llm import (
    alignment,
    bm25,
    language_model,
    licenses,
    mixing,
    near_dedup,
    packing,
    pii,
    quality,
    token_files,
    toxicity,
    url_filter,
    whitening,
)

QUERIES = {f.__name__: f for f in (
    packing.op1_best_fit_packing, url_filter.op2_url_filter, near_dedup.op3_near_duplicates,
    pii.op4_pii, mixing.op5_source_mixing, quality.op6_quality_rules, bm25.op7_bm25_top_k,
    language_model.op8_lm_score, licenses.op9_license_scan, toxicity.op10_toxicity,
    token_files.op11_token_files, whitening.op12_embedding_whitening,
    alignment.op13_tokenizer_alignment,
)}

ORACLE = {
    "op2_url_filter": url_filter.OP2_SQL,
    "op5_source_mixing": mixing.OP5_SQL,
    "op6_quality_rules": quality.OP6_SQL,
    "op9_license_scan": licenses.OP9_SQL,
}
