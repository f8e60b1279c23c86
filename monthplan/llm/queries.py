"""The registered queries of this folder and their DuckDB SQL."""

from __future__ import annotations

from . import (byte_bpe, circulant_minhash, decontaminate, html_extract, lexical_search, merkle, packing, pivot_dedup, radix_dedup,
               secret_scan, toxicity, url_filter, vp_search)

QUERIES = {
    "op1_pivot_dedup": pivot_dedup.op1_pivot_dedup,
    "op2_html_extract": html_extract.op2_html_extract,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_packing": packing.op4_packing,
    "op5_circulant_minhash": circulant_minhash.op5_circulant_minhash,
    "op6_secret_scan": secret_scan.op6_secret_scan,
    "op7_byte_bpe": byte_bpe.op7_byte_bpe,
    "op8_url_filter": url_filter.op8_url_filter,
    "op9_radix_dedup": radix_dedup.op9_radix_dedup,
    "op10_vp_search": vp_search.op10_vp_search,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_benchmark_decontamination": decontaminate.op12_benchmark_decontamination,
    "op13_ball_tree_search": lexical_search.op13_ball_tree_search,
}

ORACLE_SQL = {
    "op1_pivot_dedup": pivot_dedup.ORACLE,
    "op5_circulant_minhash": circulant_minhash.ORACLE,
    "op8_url_filter": url_filter.ORACLE,
    "op10_vp_search": vp_search.ORACLE,
    "op11_merkle_manifest": merkle.ORACLE,
    "op12_benchmark_decontamination": decontaminate.ORACLE,
    "op13_ball_tree_search": lexical_search.ORACLE,
}
