"""The registered queries of this package and their DuckDB twins."""

from __future__ import annotations

from vidlens.llm import (
    byte_bpe,
    centroid_clusters,
    conversation_repair,
    decontamination,
    embedding_dedup,
    jaccard_join,
    language_id,
    license_scans,
    lm_scoring,
    packing,
    secret_scans,
    substring_dedup,
    token_counts,
)

QUERIES = {
    "op1_best_fit_packing": packing.op1_best_fit_packing,
    "op2_ngram_jaccard_join": jaccard_join.op2_ngram_jaccard_join,
    "op3_license_scans": license_scans.op3_license_scans,
    "op4_benchmark_decontamination": decontamination.op4_benchmark_decontamination,
    "op5_language_id": language_id.op5_language_id,
    "op6_substring_dedup": substring_dedup.op6_substring_dedup,
    "op7_token_counts": token_counts.op7_token_counts,
    "op8_secret_scans": secret_scans.op8_secret_scans,
    "op9_embedding_dedup": embedding_dedup.op9_embedding_dedup,
    "op10_lm_scoring": lm_scoring.op10_lm_scoring,
    "op11_byte_bpe": byte_bpe.op11_byte_bpe,
    "op12_centroid_clusters": centroid_clusters.op12_centroid_clusters,
    "op13_conversation_repair": conversation_repair.op13_conversation_repair,
}

#: SQL expresses these; the others are tested against brute force, the libraries or held-out accuracy.
ORACLE = {
    "op3_license_scans": license_scans.oracle_sql(),
    "op4_benchmark_decontamination": decontamination.ORACLE,
    "op6_substring_dedup": substring_dedup.oracle_sql(),
    "op9_embedding_dedup": embedding_dedup.ORACLE,
    "op12_centroid_clusters": centroid_clusters.oracle_sql(),
}
