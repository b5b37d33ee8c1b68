"""Registered queries of the corpus operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from portstar.llm import (chat, decontamination, fim, html, merkle, mixing, near_dedup, periodic, pii,
                          sharding, token_counts, toxicity, urls)

LLM_QUERIES = {
    "op1_prefix_targets": chat.query,
    "op2_feistel_pseudonyms": pii.query,
    "op3_hypergeometric_shards": sharding.query,
    "op4_poisson_mixture": mixing.query,
    "op5_merkle_fingerprints": merkle.query,
    "op6_template_decontamination": decontamination.query,
    "op7_compression_toxicity": toxicity.query,
    "op8_odd_sketch_dedup": near_dedup.query,
    "op9_max_subsequence_text": html.query,
    "op10_url_bloom_filter": urls.query,
    "op11_skip_list_fim": fim.query,
    "op12_two_tier_token_counts": token_counts.query,
    "op13_internal_pattern_runs": periodic.query,
}

LLM_ORACLE = {
    "op1_prefix_targets": chat.ORACLE,
    "op4_poisson_mixture": mixing.ORACLE,
    "op10_url_bloom_filter": urls.ORACLE,
    "op11_skip_list_fim": fim.ORACLE,
}
