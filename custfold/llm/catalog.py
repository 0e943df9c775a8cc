"""Registered queries of the corpus operators: name -> builder, and the
DuckDB statements of those that SQL can express."""

from __future__ import annotations

from custfold.llm import (
    collocations,
    conversations,
    decontaminate,
    exact_dedup,
    jaccard_join,
    line_dedup,
    packing,
    secret_scan,
    sentence_dedup,
    source_mix,
    token_counts,
    toxicity,
    url_filter,
)

QUERIES = {
    "op1_url_filter": url_filter.op1_url_filter,
    "op2_source_mix": source_mix.op2_source_mix,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_ngram_jaccard_join": jaccard_join.op4_ngram_jaccard_join,
    "op5_line_dedup": line_dedup.op5_line_dedup,
    "op6_benchmark_decontamination": decontaminate.op6_benchmark_decontamination,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_secret_scan": secret_scan.op8_secret_scan,
    "op9_substring_dedup": sentence_dedup.op9_substring_dedup,
    "op10_token_counts": token_counts.op10_token_counts,
    "op11_packing": packing.op11_packing,
    "op12_conversation_repair": conversations.op12_conversation_repair,
    "op13_phrase_collocations": collocations.op13_phrase_collocations,
}

ORACLES = {
    "op1_url_filter": url_filter.OP1_SQL,
    "op3_exact_dedup": exact_dedup.OP3_SQL,
    "op5_line_dedup": line_dedup.OP5_SQL,
    "op6_benchmark_decontamination": decontaminate.OP6_SQL,
    "op12_conversation_repair": conversations.OP12_SQL,
    "op13_phrase_collocations": collocations.OP13_SQL,
}
