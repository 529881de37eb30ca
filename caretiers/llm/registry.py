"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from caretiers.llm import alignment, decontam, katz, licenses, lines, ngramjoin, packing, pii, quality, resampling, sharding, suffixes, tokenfiles

QUERIES = {
    "op1_pii": pii.query,
    "op2_token_files": tokenfiles.query,
    "op3_line_dedup": lines.query,
    "op4_benchmark_decontamination": decontam.query,
    "op5_packing": packing.query,
    "op6_suffix_dedup": suffixes.query,
    "op7_license_scan": licenses.query,
    "op8_sharding": sharding.query,
    "op9_ngram_jaccard_join": ngramjoin.query,
    "op10_quality_rules": quality.query,
    "op11_katz_scores": katz.query,
    "op12_target_resampling": resampling.query,
    "op13_tokenizer_alignment": alignment.query,
}
ORACLES = {
    "op1_pii": pii.ORACLE,
    "op3_line_dedup": lines.ORACLE,
    "op4_benchmark_decontamination": decontam.ORACLE,
    "op10_quality_rules": quality.ORACLE,
}
