"""Registered queries of the training-data operators with their SQL twins, where SQL can express one."""

from __future__ import annotations

import corpus_pipeline
from pactum.llm import chat, collocations, decontamination, fingerprints, hard_negatives, hidden_markov, language, mixing, ngram_join, quality, sharding, simhash, token_counts

QUERIES = {
    "op1_decontamination": (decontamination.op1_decontamination, decontamination.OP1_SQL),
    "op2_lm_scoring": (hidden_markov.op2_lm_scoring, None),
    "op3_ngram_join": (ngram_join.op3_ngram_join, None),
    "op4_fingerprints": (fingerprints.op4_fingerprints, None),
    "op5_mixing": (mixing.op5_mixing, mixing.OP5_SQL),
    "op6_quality": (quality.op6_quality, None),
    "op7_language_id": (language.op7_language_id, None),
    "op8_token_counts": (token_counts.op8_token_counts, None),
    "op9_sharding": (sharding.op9_sharding, None),
    "op10_chat_formatting": (chat.op10_chat_formatting, chat.OP10_SQL),
    "op11_hard_negatives": (hard_negatives.op11_hard_negatives, hard_negatives.OP11_SQL),
    "op12_collocations": (collocations.op12_collocations, collocations.OP12_SQL),
    "op13_simhash": (simhash.op13_simhash, None),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
