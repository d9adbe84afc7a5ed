"""Registered queries over the corpus tables, and their DuckDB statements."""

from __future__ import annotations

from carelake.llm import (
    filter_audit, line_dedup, packing, pairwise_quality, quality_rules, resample, search, simhash, source_mix,
    surrogates, token_counts, toxicity, warc,
)

QUERIES = {
    "op1_line_dedup": line_dedup.query,
    "op2_surrogates": surrogates.query,
    "op3_quality_rules": quality_rules.query,
    "op4_pairwise_quality": pairwise_quality.query,
    "op5_source_mix": source_mix.query,
    "op6_packing": packing.query,
    "op7_token_counts": token_counts.query,
    "op8_simhash": simhash.query,
    "op9_toxicity": toxicity.query,
    "op10_search": search.query,
    "op11_filter_audit": filter_audit.query,
    "op12_warc": warc.query,
    "op13_resample": resample.query,
}
STATEMENTS = {
    "op1_line_dedup": line_dedup.SQL,
    "op3_quality_rules": quality_rules.SQL,
    "op10_search": search.SQL,
    "op11_filter_audit": filter_audit.SQL,
    "op12_warc": warc.SQL,
    "op13_resample": resample.SQL,
}
