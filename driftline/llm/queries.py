"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chunked_bpe, exact_dedup, jaccard_join, packing, quality, substring_dedup, token_counts, topk, toxicity, urls


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_bpe_chunk_reuse": chunked_bpe.op1_bpe_chunk_reuse,
        "op2_toxicity_cnn": toxicity.op2_toxicity_cnn,
        "op3_jaccard_join": jaccard_join.op3_jaccard_join,
        "op4_threshold_top_k": topk.op4_threshold_top_k,
        "op5_best_fit_packing": packing.op5_best_fit_packing,
        "op6_quality_bayes": quality.op6_quality_bayes,
        "op7_token_counts": token_counts.op7_token_counts,
        "op8_url_templates": urls.op8_url_templates,
        "op9_paragraph_minhash": substring_dedup.op9_paragraph_minhash,
        "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_jaccard_join": jaccard_join.OP3_SQL, "op4_threshold_top_k": topk.OP4_SQL, "op8_url_templates": urls.OP8_SQL, "op10_exact_dedup": exact_dedup.OP10_SQL}
