"""Registered queries of this subpackage and their checks in SQL."""

from mendlake.llm import bpe, centroids, html_text, kd_search, line_dedup, mixing, ngram_join, pseudo_likelihood, quality, sharding
from mendlake.llm import suffix_dedup, token_blocks, word_runs

QUERIES = {
    "op1_hilbert_shards": sharding.op1_hilbert_shards,
    "op2_line_windows": line_dedup.op2_line_windows,
    "op3_text_density": html_text.op3_text_density,
    "op4_quality_divergence": quality.op4_quality_divergence,
    "op5_prefix_tree_join": ngram_join.op5_prefix_tree_join,
    "op6_pseudo_likelihood": pseudo_likelihood.op6_pseudo_likelihood,
    "op7_bwt_dedup": suffix_dedup.op7_bwt_dedup,
    "op8_kd_search": kd_search.op8_kd_search,
    "op9_mix_sources": mixing.op9_mix_sources,
    "op10_bpe_round_trip": bpe.op10_bpe_round_trip,
    "op11_ptolemaic_clusters": centroids.op11_ptolemaic_clusters,
    "op12_token_blocks": token_blocks.op12_token_blocks,
    "op13_word_runs": word_runs.op13_word_runs,
}

CHECKS = {**line_dedup.SQL, **quality.SQL, **ngram_join.SQL, **kd_search.SQL, **centroids.SQL}
