"""Registered queries of the training-data operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from . import (blob_ledger, bpe, collision_ann, fill_middle, host_reputation, lang_id, line_quality, ngram_join, page_diff,
               source_mix, spelling_variants, token_counts, toxicity)


def queries() -> dict:
    return {
        "op1_token_counts": token_counts.q_token_counts,
        "op2_toxicity": toxicity.q_toxicity,
        "op3_collision_ann": collision_ann.q_collision_ann,
        "op4_line_quality": line_quality.q_line_quality,
        "op5_page_diff": page_diff.q_page_diff,
        "op6_blob_ledger": blob_ledger.q_blob_ledger,
        "op7_ngram_join": ngram_join.q_ngram_join,
        "op8_bpe": bpe.q_bpe,
        "op9_source_mix": source_mix.q_source_mix,
        "op10_lang_id": lang_id.q_lang_id,
        "op11_spelling_variants": spelling_variants.q_spelling_variants,
        "op12_host_reputation": host_reputation.q_host_reputation,
        "op13_fill_middle": fill_middle.q_fill_middle,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_line_quality": line_quality.ORACLE,
        "op9_source_mix": source_mix.ORACLE,
        "op12_host_reputation": host_reputation.ORACLE,
        "op13_fill_middle": fill_middle.ORACLE,
    }
