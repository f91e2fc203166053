"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from adherence.llm import (alignment, exact_dedup, html_blocks, importance, line_dedup, lm, mixing, piece_lattice, quality_rules,
                            simhash, substrings, toxicity, zstd_quality)

QUERIES = {
    "op1_html_blocks": html_blocks.op1_html_blocks,
    "op2_simhash_dedup": simhash.op2_simhash_dedup,
    "op3_line_dedup": line_dedup.op3_line_dedup,
    "op4_zstd_quality": zstd_quality.op4_zstd_quality,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_toxic_segments": toxicity.op6_toxic_segments,
    "op7_piece_sampling": piece_lattice.op7_piece_sampling,
    "op8_mix_sources": mixing.op8_mix_sources,
    "op9_lm_scoring": lm.op9_lm_scoring,
    "op10_quality_rules": quality_rules.op10_quality_rules,
    "op11_tokenizer_alignment": alignment.op11_tokenizer_alignment,
    "op12_substring_dedup": substrings.op12_substring_dedup,
    "op13_importance_resampling": importance.op13_importance_resampling,
}
SQL = {
    "op3_line_dedup": line_dedup.SQL,
    "op5_exact_dedup": exact_dedup.SQL,
    "op10_quality_rules": quality_rules.SQL,
}
