"""The registered queries of the training-data operators and their SQL, where SQL can express them."""

from __future__ import annotations

from . import decontaminate, exact_dedup, language_id, license_scan, line_dedup, packing, pii, simhash, substring_dedup, token_counts, token_files, turns, whitening

QUERIES = {
    "op1_decontaminate": decontaminate.op1_decontaminate,
    "op2_language_id": language_id.op2_language_id,
    "op3_packing": packing.op3_packing,
    "op4_token_counts": token_counts.op4_token_counts,
    "op5_substring_dedup": substring_dedup.op5_substring_dedup,
    "op6_token_files": token_files.op6_token_files,
    "op7_personal_data": pii.op7_personal_data,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_simhash": simhash.op10_simhash,
    "op11_whitening": whitening.op11_whitening,
    "op12_turn_repair": turns.op12_turn_repair,
    "op13_license_scan": license_scan.op13_license_scan,
}

ORACLE_SQL = {
    "op8_line_dedup": line_dedup.OP8_SQL,
    "op9_exact_dedup": exact_dedup.OP9_SQL,
}
