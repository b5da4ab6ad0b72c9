"""Queries of the ten operators and their SQL where SQL can express them."""

from __future__ import annotations

from marlstone.llm import bpe, chat, embed_dedup, exact_dedup, language_id, mixing, ngram_join, pii, sharding, suffix_dedup

QUERIES = {
    "op1_suffix_array_dedup": suffix_dedup.query,
    "op2_exact_dedup": exact_dedup.query,
    "op3_ngram_jaccard_join": ngram_join.query,
    "op4_mixing": mixing.query,
    "op5_sharding": sharding.query,
    "op6_language_id": language_id.query,
    "op7_embedding_near_dedup": embed_dedup.query,
    "op8_pii": pii.query,
    "op9_byte_bpe": bpe.query,
    "op10_chat_formatting": chat.query,
}

ORACLES = {
    "op2_exact_dedup": exact_dedup.SQL,
    "op4_mixing": mixing.SQL,
    "op10_chat_formatting": chat.SQL,
}
