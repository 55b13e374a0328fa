"""The queries of this subpackage and their SQL, for __spark_entry__.py."""

from __future__ import annotations

from . import decontaminate, manifest, near_dedup, packing, pii, quality, secrets, substring_dedup, suffix_dedup, topk, toxicity, url_filter, whitening

QUERIES = {
    "op1_decontaminate": decontaminate.op1_decontaminate,
    "op2_quality": quality.op2_quality,
    "op3_packing": packing.op3_packing,
    "op4_secrets": secrets.op4_secrets,
    "op5_substring_dedup": substring_dedup.op5_substring_dedup,
    "op6_topk": topk.op6_topk,
    "op7_near_dedup": near_dedup.op7_near_dedup,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_pii": pii.op9_pii,
    "op10_url_filter": url_filter.op10_url_filter,
    "op11_whitening": whitening.op11_whitening,
    "op12_suffix_dedup": suffix_dedup.op12_suffix_dedup,
    "op13_merkle": manifest.op13_merkle,
}

ORACLES = {
    "op1_decontaminate": decontaminate.ORACLE_SQL,
    "op5_substring_dedup": substring_dedup.ORACLE_SQL,
    "op6_topk": topk.ORACLE_SQL,
    "op7_near_dedup": near_dedup.ORACLE_SQL,
    "op12_suffix_dedup": suffix_dedup.ORACLE_SQL,
    "op13_merkle": manifest.ORACLE_SQL,
}
