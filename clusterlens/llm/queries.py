"""Registered queries of this folder and their SQL twins."""

from __future__ import annotations

from clusterlens.llm import (bpe, chat_format, collocations, compression_quality,
                             decontaminate, embedding_whitening, language_id, near_dedup, quality_rules, resharding, token_files,
                             toxicity, wrapper_induction)

QUERIES = {
    "op1_chat_format": chat_format.query,
    "op2_token_files": token_files.query,
    "op3_bpe": bpe.query,
    "op4_compression_quality": compression_quality.query,
    "op5_decontaminate": decontaminate.query,
    "op6_toxicity": toxicity.query,
    "op7_wrapper_induction": wrapper_induction.query,
    "op8_quality_rules": quality_rules.query,
    "op9_resharding": resharding.query,
    "op10_near_dedup": near_dedup.query,
    "op11_language_id": language_id.query,
    "op12_collocations": collocations.query,
    "op13_whitening": embedding_whitening.query,
}

# the others cannot be said in SQL; tests/llm holds them against brute force
ORACLE = {
    "op1_chat_format": chat_format.ORACLE,
    "op5_decontaminate": decontaminate.ORACLE,
    "op8_quality_rules": quality_rules.ORACLE,
    "op12_collocations": collocations.ORACLE,
}
