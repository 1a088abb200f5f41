"""Registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from tidemark.llm import (
    byte_bpe,
    decontaminate,
    filter_audit,
    fm_dedup,
    importance,
    language_id,
    license_scan,
    nearest,
    secret_scan,
    simhash,
    suffix_dedup,
    token_count,
    toxicity,
)

QUERIES = {
    "op1_license_scans": license_scan.op1,
    "op2_nearest_neighbours": nearest.op2,
    "op3_decontamination": decontaminate.op3,
    "op4_token_counts": token_count.op4,
    "op5_secret_scans": secret_scan.op5,
    "op6_byte_bpe": byte_bpe.op6,
    "op7_language_id": language_id.op7,
    "op8_suffix_array_dedup": suffix_dedup.op8,
    "op9_simhash": simhash.op9,
    "op10_substring_dedup": fm_dedup.op10,
    "op11_filter_audit": filter_audit.op11,
    "op12_importance_resampling": importance.op12,
    "op13_toxicity": toxicity.op13,
}
SQL = {
    "op3_decontamination": decontaminate.OP3_SQL,
    "op5_secret_scans": secret_scan.OP5_SQL,
    "op10_substring_dedup": fm_dedup.OP10_SQL,
    "op11_filter_audit": filter_audit.OP11_SQL,
    "op12_importance_resampling": importance.OP12_SQL,
}
