"""The registered queries of this package, and SQL for those that SQL can express."""

from __future__ import annotations

from tilewright.llm import ann, bpe, chat, kdtree, mixing, prefix_tokens, quality, simhash, store, suffix_dedup

QUERIES = {
    "op1_ivf_pq": ann.op1_ivf_pq,
    "op2_token_counts": prefix_tokens.op2_token_counts,
    "op3_simhash": simhash.op3_simhash,
    "op4_suffix_dedup": suffix_dedup.op4_suffix_dedup,
    "op5_bpe_round_trip": bpe.op5_bpe_round_trip,
    "op6_quality_rules": quality.op6_quality_rules,
    "op7_mix_sources": mixing.op7_mix_sources,
    "op8_chat_round_trip": chat.op8_chat_round_trip,
    "op9_kd_shards": kdtree.op9_kd_shards,
    "op10_id_store": store.op10_id_store,
}

ORACLE_SQL: dict[str, str] = {}
