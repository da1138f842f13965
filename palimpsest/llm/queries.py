"""The operators' queries and their SQL twins, by name."""

from palimpsest.llm import (
    decontamination,
    embedding_dedup,
    jaccard_join,
    packing,
    paragraph_dedup,
    pii,
    ptolemaic_clustering,
    quality,
    suffix_dedup,
    token_store,
    toxicity,
    url_filters,
    vector_codes,
)

QUERIES = {
    "op1_ngram_jaccard_join": jaccard_join.op1_ngram_jaccard_join,
    "op2_url_filters": url_filters.op2_url_filters,
    "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
    "op4_best_fit_packing": packing.op4_best_fit_packing,
    "op5_pii": pii.op5_pii,
    "op6_embedding_near_dedup": embedding_dedup.op6_embedding_near_dedup,
    "op7_quality_classifier": quality.op7_quality_classifier,
    "op8_decontamination": decontamination.op8_decontamination,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_substring_dedup": paragraph_dedup.op10_substring_dedup,
    "op11_centroid_clustering": ptolemaic_clustering.op11_centroid_clustering,
    "op12_vector_codes": vector_codes.op12_vector_codes,
    "op13_token_store": token_store.op13_token_store,
}
SQL = {
    "op1_ngram_jaccard_join": jaccard_join.SQL,
    "op2_url_filters": url_filters.SQL,
    "op11_centroid_clustering": ptolemaic_clustering.SQL,
    "op12_vector_codes": vector_codes.SQL,
}
