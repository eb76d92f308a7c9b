"""The queries of this subpackage and, where SQL can express one, its DuckDB form."""

from __future__ import annotations

from . import bpe, langid, linededup, lzfingerprint, mixing, neardup, pii, quality, tokencount, toxicity

QUERIES = {
    "op1_quality_mcd": quality.op1_quality_mcd,
    "op2_language_centroids": langid.op2_language_centroids,
    "op3_mix_min_cost_flow": mixing.op3_mix_min_cost_flow,
    "op4_byte_bpe": bpe.op4_byte_bpe,
    "op5_line_dedup": linededup.op5_line_dedup,
    "op6_lz_fingerprint": lzfingerprint.op6_lz_fingerprint,
    "op7_minhash_near_dedup": neardup.op7_minhash_near_dedup,
    "op8_edit_token_counts": tokencount.op8_edit_token_counts,
    "op9_information_sanitisation": pii.op9_information_sanitisation,
    "op10_toxicity": toxicity.op10_toxicity,
}

ORACLE: dict[str, str] = {
    "op3_mix_min_cost_flow": mixing.ORACLE,
    "op7_minhash_near_dedup": neardup.ORACLE,
}
