"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from . import op01_toxicity, op02_gif, op03_substring_dedup, op04_sharding, op05_decontamination, op06_url_filter, op07_jaccard_join, op08_licences, op09_packing, op10_quality


def queries() -> dict:
    return {
        "op1_toxicity": op01_toxicity.query,
        "op2_gif": op02_gif.query,
        "op3_substring_dedup": op03_substring_dedup.query,
        "op4_sharding": op04_sharding.query,
        "op5_decontamination": op05_decontamination.query,
        "op6_url_filter": op06_url_filter.query,
        "op7_jaccard_join": op07_jaccard_join.query,
        "op8_licences": op08_licences.query,
        "op9_packing": op09_packing.query,
        "op10_quality": op10_quality.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_substring_dedup": op03_substring_dedup.SQL,
        "op6_url_filter": op06_url_filter.SQL,
        "op7_jaccard_join": op07_jaccard_join.SQL,
        "op8_licences": op08_licences.SQL,
    }
