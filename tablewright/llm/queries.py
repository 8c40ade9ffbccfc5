"""The registered queries of this subpackage: name -> (Spark builder, DuckDB SQL or None)."""

from __future__ import annotations

from . import bpe, centroid_cluster, collocations, embed_dedup, host_quality, jaccard_join, license_scan, mixing, substring_dedup, token_counts, toxicity, url_filter, weak_quality


def queries() -> dict:
    return {
        "op1_mix_sources": (mixing.query, mixing.SQL),
        "op2_bpe_encode": (bpe.query, None),
        "op3_embedding_near_dedup": (embed_dedup.query, None),
        "op4_license_scan": (license_scan.query, license_scan.SQL),
        "op5_toxicity": (toxicity.query, None),
        "op6_ngram_jaccard_join": (jaccard_join.query, None),
        "op7_url_filter": (url_filter.query, url_filter.SQL),
        "op8_token_counts": (token_counts.query, None),
        "op9_host_quality": (host_quality.query, host_quality.SQL),
        "op10_weak_quality": (weak_quality.query, None),
        "op11_collocations": (collocations.query, collocations.SQL),
        "op12_substring_dedup": (substring_dedup.query, substring_dedup.SQL),
        "op13_centroid_cluster": (centroid_cluster.query, centroid_cluster.SQL),
    }
