"""Operations of a training-data pipeline. Nothing else in the package imports this one."""

from __future__ import annotations

from . import op1_spans, op2_leaks, op3_quality, op4_rules, op5_wrappers, op6_chat, op7_suffix, op8_simhash, op9_packing, op10_licenses

QUERIES = {
    "op1_substring_dedup": op1_spans.op1_substring_dedup,
    "op2_benchmark_decontamination": op2_leaks.op2_benchmark_decontamination,
    "op3_quality_classifier": op3_quality.op3_quality_classifier,
    "op4_quality_rules": op4_rules.op4_quality_rules,
    "op5_html_extraction": op5_wrappers.op5_html_extraction,
    "op6_chat_formatting": op6_chat.op6_chat_formatting,
    "op7_suffix_array_dedup": op7_suffix.op7_suffix_array_dedup,
    "op8_simhash_near_dedup": op8_simhash.op8_simhash_near_dedup,
    "op9_best_fit_packing": op9_packing.op9_best_fit_packing,
    "op10_license_scan": op10_licenses.op10_license_scan,
}
#: What SQL can't express here is tested against brute force in tests/llm.
ORACLES: dict[str, str] = {}
