"""Queries of the text operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from cartwheel.llm import decontaminate, divergence, extract, language, manifest, minhash, passages, pieces, pii, quality, sequence_files, spots, token_files
from cartwheel.session import prepare


def _prepared(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(prepare(spark), sf_dir)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    builds = [
        spots.op1_spot_signatures,
        extract.op2_html_extraction,
        quality.op3_quality,
        token_files.op4_token_counts,
        passages.op5_substring_dedup,
        minhash.op6_minhash_near_dedup,
        decontaminate.op7_benchmark_decontamination,
        pieces.op8_sentencepiece,
        language.op9_language_id,
        pii.op10_pii_surrogates,
        divergence.op11_divergence_audit,
        sequence_files.op12_token_sequences,
        manifest.op13_merkle_manifest,
    ]
    return {b.__name__: _prepared(b) for b in builds} | {"pipeline": corpus_pipeline.run}


def statements() -> dict[str, str]:
    sql = {
        "op6_minhash_near_dedup": minhash.OP6_SQL,
        "op7_benchmark_decontamination": decontaminate.OP7_SQL,
        "op11_divergence_audit": divergence.OP11_SQL,
        "op13_merkle_manifest": manifest.OP13_SQL,
        "pipeline": corpus_pipeline.ORACLE_SQL,
    }
    return {name: text for name, text in sql.items() if text}
