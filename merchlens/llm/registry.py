"""All registered queries of this folder, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import queries_chat, queries_dedup, queries_models, queries_rules, queries_scan, queries_tokens, queries_vectors

QUERIES = {
    "op1_substring_dedup": queries_dedup.op1_substring_dedup,
    "op2_secrets": queries_rules.op2_secrets,
    "op3_sentence_pieces": queries_tokens.op3_sentence_pieces,
    "op4_line_dedup": queries_dedup.op4_line_dedup,
    "op5_decontaminate": queries_scan.op5_decontaminate,
    "op6_licenses": queries_rules.op6_licenses,
    "op7_toxicity": queries_models.op7_toxicity,
    "op8_interpolation": queries_models.op8_interpolation,
    "op9_near_duplicates": queries_dedup.op9_near_duplicates,
    "op10_exact_dedup": queries_dedup.op10_exact_dedup,
    "op11_turn_repair": queries_chat.op11_turn_repair,
    "op12_byte_pairs": queries_tokens.op12_byte_pairs,
    "op13_whitening": queries_vectors.op13_whitening,
}
SQL = {"op4_line_dedup": queries_dedup.OP4_SQL, "op1_substring_dedup": queries_dedup.OP1_SQL, "op5_decontaminate": queries_scan.OP5_SQL, "op9_near_duplicates": queries_dedup.OP9_SQL, "op10_exact_dedup": queries_dedup.OP10_SQL}
