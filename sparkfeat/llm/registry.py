"""The queries of this subpackage and the DuckDB SQL for those SQL can express."""
from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from . import conversations, decontam, embeddings, jaccard, line_dedup, merkle, mixing, quality, secret_scan, sharding, token_counts, urls, warc


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pq_neardup": embeddings.op1_pq_neardup,
        "op2_arc_to_warc": warc.op2_arc_to_warc,
        "op3_curriculum_mix": mixing.op3_curriculum_mix,
        "op4_secret_ownership": secret_scan.op4_secret_ownership,
        "op5_edit_aware_counts": token_counts.op5_edit_aware_counts,
        "op6_decontamination": decontam.op6_decontamination,
        "op7_quality_resampling": quality.op7_quality_resampling,
        "op8_jaccard_join": jaccard.op8_jaccard_join,
        "op9_url_rules": urls.op9_url_rules,
        "op10_label_sharding": sharding.op10_label_sharding,
        "op11_merkle_manifest": merkle.op11_merkle_manifest,
        "op12_block_repair": conversations.op12_block_repair,
        "op13_line_runs": line_dedup.op13_line_runs,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    found = {
        "op1_pq_neardup": embeddings.ORACLE,
        "op2_arc_to_warc": warc.ORACLE,
        "op3_curriculum_mix": mixing.ORACLE,
        "op4_secret_ownership": secret_scan.ORACLE,
        "op9_url_rules": urls.ORACLE,
        "op11_merkle_manifest": merkle.ORACLE,
        "op12_block_repair": conversations.ORACLE,
        "op13_line_runs": line_dedup.ORACLE,
    }
    if corpus_pipeline.ORACLE_SQL is not None:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
