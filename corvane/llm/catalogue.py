"""The queries of this subpackage and their oracles."""

from __future__ import annotations

from corvane.llm import (decontamination, exact_dedup, jaccard_join, language, line_dedup, merkle, packing,
                         prefix_trie, resampling, secrets, sharding, token_counts, warc)

QUERIES = {
    "op1_warc_normaliser": warc.op1_warc_normaliser,
    "op2_jaccard_join": jaccard_join.op2_jaccard_join,
    "op3_best_fit_packing": packing.op3_best_fit_packing,
    "op4_benchmark_decontamination": decontamination.op4_benchmark_decontamination,
    "op5_importance_resampling": resampling.op5_importance_resampling,
    "op6_stratified_interleaving": sharding.op6_stratified_interleaving,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_exact_dedup": exact_dedup.op8_exact_dedup,
    "op9_language_id": language.op9_language_id,
    "op10_edit_aware_counts": token_counts.op10_edit_aware_counts,
    "op11_secret_scan": secrets.op11_secret_scan,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
}

ORACLES = {
    "op1_warc_normaliser": warc.OP1_SQL,
    "op7_line_dedup": line_dedup.OP7_SQL,
    "op8_exact_dedup": exact_dedup.OP8_SQL,
    "op11_secret_scan": secrets.OP11_SQL,
    "op12_prefix_trie": prefix_trie.OP12_SQL,
    "op13_merkle_manifest": merkle.OP13_SQL,
}
