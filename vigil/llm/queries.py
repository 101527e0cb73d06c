"""Registered queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from vigil.llm import chat, embeddings, mixing, pivots, ranking, substring, trie
from vigil.llm.langid import op7_language_id
from vigil.llm.packing import op1_best_fit_packing
from vigil.llm.shards import op8_token_shards
from vigil.llm.simhash import op2_simhash
from vigil.llm.sketches import op4_fingerprints
from vigil.llm.token_counts import op10_token_counts

QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_simhash": op2_simhash,
    "op3_embedding_dedup": embeddings.op3_embedding_dedup,
    "op4_fingerprints": op4_fingerprints,
    "op5_chat": chat.op5_chat,
    "op6_mixing": mixing.op6_mixing,
    "op7_language_id": op7_language_id,
    "op8_token_shards": op8_token_shards,
    "op9_substring_dedup": substring.op9_substring_dedup,
    "op10_token_counts": op10_token_counts,
    "op11_topk_search": pivots.op11_topk_search,
    "op12_prefix_trie": trie.op12_prefix_trie,
    "op13_lexical_search": ranking.op13_lexical_search,
}

# The others need tokenizers, 64-bit hashes or trained profiles; tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {
    "op3_embedding_dedup": embeddings.SQL,
    "op5_chat": chat.SQL,
    "op6_mixing": mixing.SQL,
    "op9_substring_dedup": substring.SQL,
    "op11_topk_search": pivots.SQL,
    "op12_prefix_trie": trie.SQL,
    "op13_lexical_search": ranking.SQL,
}
