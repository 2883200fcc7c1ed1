"""Queries of this package by name, and the SQL of those SQL can express."""
from __future__ import annotations

from balances.llm import (
    chunk_bpe,
    decontaminate,
    hard_negatives,
    hyperminhash,
    langid,
    line_dedup,
    main_text,
    prefix_trie,
    quality_crf,
    quotient_dedup,
    token_records,
    toxicity,
    word_tokens,
)


def queries() -> dict:
    return {
        "op1_main_text": main_text.op1_main_text,
        "op2_bpe_round_trip": chunk_bpe.op2_bpe_round_trip,
        "op3_token_counts": word_tokens.op3_token_counts,
        "op4_token_records": token_records.op4_token_records,
        "op5_near_duplicates": hyperminhash.op5_near_duplicates,
        "op6_exact_dedup": quotient_dedup.op6_exact_dedup,
        "op7_toxicity": toxicity.op7_toxicity,
        "op8_language_id": langid.op8_language_id,
        "op9_decontaminate": decontaminate.op9_decontaminate,
        "op10_line_dedup": line_dedup.op10_line_dedup,
        "op11_hard_negatives": hard_negatives.op11_hard_negatives,
        "op12_prefix_trie": prefix_trie.op12_prefix_trie,
        "op13_quality": quality_crf.op13_quality,
    }


def oracle_sql() -> dict[str, str]:
    return {"op6_exact_dedup": quotient_dedup.SQL, "op9_decontaminate": decontaminate.SQL,
            "op11_hard_negatives": hard_negatives.SQL, "op12_prefix_trie": prefix_trie.SQL}
