"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from corpuslake.llm import clusters, decontaminate, exact_dedup, language, line_dedup, lm, minhash, mixture, negatives, passages, pii, quality, urls

QUERIES = {
    "op1_minhash_dedup": minhash.op1_minhash_dedup,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_pii": pii.op3_pii,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_quality": quality.op5_quality,
    "op6_lm_score": lm.op6_lm_score,
    "op7_substring_dedup": passages.op7_substring_dedup,
    "op8_url_filter": urls.op8_url_filter,
    "op9_mixture": mixture.op9_mixture,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_language_id": language.op11_language_id,
    "op12_hard_negatives": negatives.op12_hard_negatives,
    "op13_centroids": clusters.op13_centroids,
}

#: The others are tested against brute force or by held-out accuracy.
ORACLE = {
    "op1_minhash_dedup": minhash.ORACLE,
    "op2_decontaminate": decontaminate.ORACLE,
    "op4_line_dedup": line_dedup.ORACLE,
    "op8_url_filter": urls.ORACLE,
    "op10_exact_dedup": exact_dedup.ORACLE,
    "op12_hard_negatives": negatives.ORACLE,
    "op13_centroids": clusters.ORACLE,
}
