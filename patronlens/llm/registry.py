"""The queries of this subpackage by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from patronlens.llm import (conversations, fingerprints, language_id, lm_scoring, minhash_dedup,
                            nearest, packing, pieces, quality, runs, secret_scan,
                            substring_dedup, toxicity)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [substring_dedup.op1_substring_dedup, packing.op2_best_fit_packing,
             pieces.op3_sentencepiece, quality.op4_quality_classifier, lm_scoring.op5_lm_scoring,
             fingerprints.op6_document_fingerprints, minhash_dedup.op7_minhash_dedup,
             toxicity.op8_toxicity, nearest.op9_nearest_neighbours,
             language_id.op10_language_id, conversations.op11_conversation_repair,
             secret_scan.op12_secret_scan, runs.op13_periodic_runs]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op1_substring_dedup": substring_dedup.SQL,
            "op7_minhash_dedup": minhash_dedup.SQL,
            "op11_conversation_repair": conversations.SQL}
