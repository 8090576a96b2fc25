"""Queries of this subpackage: name -> function of (spark, sf_dir), and oracle SQL."""

from __future__ import annotations

from flowml.llm import (alignment, exact_dedup, jaccard, langid, lm_scoring, minhash, mixing, packing, quality,
                        secrets, topk, vector_codes, warc)

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_lm_scores": lm_scoring.op2_lm_scores,
    "op3_quality": quality.op3_quality,
    "op4_secret_scan": secrets.op4_secret_scan,
    "op5_source_mix": mixing.op5_source_mix,
    "op6_language_id": langid.op6_language_id,
    "op7_topk_search": topk.op7_topk_search,
    "op8_best_two_fit": packing.op8_best_two_fit,
    "op9_jaccard_join": jaccard.op9_jaccard_join,
    "op10_warc_revisits": warc.op10_warc_revisits,
    "op11_minhash": minhash.op11_minhash,
    "op12_vector_codes": vector_codes.op12_vector_codes,
    "op13_token_alignment": alignment.op13_token_alignment,
}

ORACLE = {
    "op1_exact_dedup": exact_dedup.SQL,
    "op5_source_mix": mixing.SQL,
    "op7_topk_search": topk.SQL,
    "op10_warc_revisits": warc.SQL,
    "op12_vector_codes": vector_codes.SQL,
}
