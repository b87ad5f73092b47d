"""Queries of the corpus operators and, where SQL can express them, DuckDB SQL."""

from __future__ import annotations

from blotter.llm import alignment, automaton, exact_dedup, hard_negatives, language_model, licenses, near_dedup, packing, personal_data, repetition, secrets, suffix_dedup, token_files

QUERIES = {
    "op1_secret_ownership": secrets.query,
    "op2_suffix_dedup": suffix_dedup.query,
    "op3_deleted_interpolation": language_model.query,
    "op4_semi_crf_pii": personal_data.query,
    "op5_license_digest": licenses.query,
    "op6_token_automaton": automaton.query,
    "op7_bloom_exact_dedup": exact_dedup.query,
    "op8_repetition_rules": repetition.query,
    "op9_best_two_fit": packing.query,
    "op10_chosen_path_near_dedup": near_dedup.query,
    "op11_token_alignment": alignment.query,
    "op12_elias_fano_files": token_files.query,
    "op13_angular_negatives": hard_negatives.query,
}
SQL = {
    "op5_license_digest": licenses.SQL,
    "op7_bloom_exact_dedup": exact_dedup.SQL,
    "op13_angular_negatives": hard_negatives.SQL,
}
