"""The package's queries by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from orderlens.llm import (
    chat, conversation_repair, decontaminate, exact_dedup, katz, langid, line_dedup, pieces, pii, quality, simhash, url_filter, whitening,
)

QUERIES = {
    "op1_sentencepiece": pieces.op1_sentencepiece,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_chat_formatting": chat.op3_chat_formatting,
    "op4_language_id": langid.op4_language_id,
    "op5_simhash_near_dedup": simhash.op5_simhash_near_dedup,
    "op6_quality_classifier": quality.op6_quality_classifier,
    "op7_benchmark_decontamination": decontaminate.op7_benchmark_decontamination,
    "op8_exact_dedup": exact_dedup.op8_exact_dedup,
    "op9_pii": pii.op9_pii,
    "op10_lm_scoring": katz.op10_lm_scoring,
    "op11_embedding_whitening": whitening.op11_embedding_whitening,
    "op12_conversation_repair": conversation_repair.op12_conversation_repair,
    "op13_url_filters": url_filter.op13_url_filters,
}

ORACLE = {
    "op2_line_dedup": line_dedup.SQL,
    "op3_chat_formatting": chat.SQL,
    "op8_exact_dedup": exact_dedup.SQL,
    "op13_url_filters": url_filter.SQL,
}
