"""Queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from . import ann, bpe, exact_dedup, licenses, mixing, near_dedup, sharding, token_counts, toxicity, url_filter


def queries() -> dict:
    return {
        "op1_exact_dedup": exact_dedup.op1_exact_dedup,
        "op2_ann": ann.op2_ann,
        "op8_licenses": licenses.op8_licenses,
        "op3_near_dedup": near_dedup.op3_near_dedup,
        "op4_mixing": mixing.op4_mixing,
        "op5_token_counts": token_counts.op5_token_counts,
        "op9_bpe": bpe.op9_bpe,
        "op10_url_filter": url_filter.op10_url_filter,
        "op6_toxicity": toxicity.op6_toxicity,
        "op7_sharding": sharding.op7_sharding,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": exact_dedup.SQL, "op10_url_filter": url_filter.SQL}
