"""The queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from demandgrid.llm import (
    decontamination,
    line_dedup,
    mixing,
    perplexity,
    pii,
    resampling,
    secret_scan,
    signature_join,
    simhash,
    token_counts,
    toxicity,
    warc,
    whitening,
)

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_personal_data": pii.op2_personal_data,
    "op3_source_mix": mixing.op3_source_mix,
    "op4_secret_entropy": secret_scan.op4_secret_entropy,
    "op5_warc_normaliser": warc.op5_warc_normaliser,
    "op6_perplexity_bands": perplexity.op6_perplexity_bands,
    "op7_spaced_seeds": decontamination.op7_spaced_seeds,
    "op8_simhash_pivots": simhash.op8_simhash_pivots,
    "op9_separator_scan": token_counts.op9_separator_scan,
    "op10_line_dedup": line_dedup.op10_line_dedup,
    "op11_whitening": whitening.op11_whitening,
    "op12_signature_join": signature_join.op12_signature_join,
    "op13_importance_resampling": resampling.op13_importance_resampling,
}

ORACLE = {
    "op3_source_mix": mixing.OP3_SQL,
    "op5_warc_normaliser": warc.OP5_SQL,
    "op12_signature_join": signature_join.OP12_SQL,
    "op13_importance_resampling": resampling.OP13_SQL,
}
