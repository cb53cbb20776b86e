"""Queries of the training-data operators and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from ledgerwatch.llm import chat, decontaminate, embeddings, lm, minhash, mixing, passages, phrases, pii, quality, resample, toxicity, urls

QUERIES = {
    "op1_cover_tree": embeddings.op1_cover_tree,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_benchmark_decontamination": decontaminate.op3_benchmark_decontamination,
    "op4_prefix_tree": chat.op4_prefix_tree,
    "op5_minhash_odd_sketch": minhash.op5_minhash_odd_sketch,
    "op6_link_propagation": urls.op6_link_propagation,
    "op7_poisson_mixing": mixing.op7_poisson_mixing,
    "op8_deleted_interpolation": lm.op8_deleted_interpolation,
    "op9_pii_weak_supervision": pii.op9_pii_weak_supervision,
    "op10_collinear_chaining": passages.op10_collinear_chaining,
    "op11_line_labelling": quality.op11_line_labelling,
    "op12_quotient_filters": phrases.op12_quotient_filters,
    "op13_importance_resampling": resample.op13_importance_resampling,
}

ORACLE = {
    "op4_prefix_tree": chat.ORACLE,
    "op7_poisson_mixing": mixing.oracle(),
    "op12_quotient_filters": phrases.ORACLE,
    "op13_importance_resampling": resample.ORACLE,
}
