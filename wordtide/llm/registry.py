"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from wordtide.llm import (ann, centroids, exact_dedup, mixing, near_dedup, packing, pii, prefix_trie, quality, repair, suffix_dedup,
                          token_count, warc)

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
    "op2_packing": packing.op2_packing,
    "op3_quality": quality.op3_quality,
    "op4_mixing": mixing.op4_mixing,
    "op5_hilbert_ann": ann.op5_hilbert_ann,
    "op6_token_counts": token_count.op6_token_counts,
    "op7_pii": pii.op7_pii,
    "op8_minhash_near_dedup": near_dedup.op8_minhash_near_dedup,
    "op9_warc": warc.op9_warc,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_centroids": centroids.op12_centroids,
    "op13_repair": repair.op13_repair,
}

ORACLE = {
    "op10_exact_dedup": exact_dedup.SQL,
    "op11_prefix_trie": prefix_trie.SQL,
    "op12_centroids": centroids.SQL,
}
