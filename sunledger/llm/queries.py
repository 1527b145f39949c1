"""The registered queries of this folder and their SQL."""

from __future__ import annotations

from sunledger.llm import (
    chat_format,
    decontaminate,
    license_scan,
    ngram_join,
    pii,
    quality_gam,
    quality_rules,
    secret_scan,
    sentence_pieces,
    token_counts,
    turn_repair,
    url_filter,
    word_runs,
)

REGISTRY = {
    f.__name__: f
    for f in (
        ngram_join.op1_ngram_jaccard_join,
        license_scan.op2_license_scan,
        quality_gam.op3_quality_classifier,
        secret_scan.op4_secret_scan,
        url_filter.op5_url_filter,
        chat_format.op6_chat_format,
        decontaminate.op7_benchmark_decontamination,
        sentence_pieces.op8_sentencepiece,
        pii.op9_personal_data,
        quality_rules.op10_quality_rules,
        turn_repair.op11_turn_repair,
        word_runs.op12_word_runs,
        token_counts.op13_token_counts,
    )
}

ORACLES = {
    "op1_ngram_jaccard_join": ngram_join.ORACLE,
    "op5_url_filter": url_filter.ORACLE,
    "op6_chat_format": chat_format.ORACLE,
    "op7_benchmark_decontamination": decontaminate.ORACLE,
}
