"""The queries of this folder, and SQL for those that SQL can express."""

from __future__ import annotations

from marketlake.llm import (
    exact_dedup,
    imatch,
    language,
    line_dedup,
    mixing,
    packing,
    prefix_trie,
    secrets,
    sharding,
    simhash,
    toxicity,
    url_filter,
    whitening,
)

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_fingerprints": imatch.op2_fingerprints,
    "op3_language_id": language.op3_language_id,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_url_filter": url_filter.op6_url_filter,
    "op7_secrets": secrets.op7_secrets,
    "op8_simhash": simhash.op8_simhash,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_mixing": mixing.op10_mixing,
    "op11_sharding": sharding.op11_sharding,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_whitening": whitening.op13_whitening,
}

SQL = {
    "op4_line_dedup": line_dedup.SQL,
    "op5_exact_dedup": exact_dedup.SQL,
    "op6_url_filter": url_filter.SQL,
    "op10_mixing": mixing.SQL,
    "op12_prefix_trie": prefix_trie.SQL,
}
