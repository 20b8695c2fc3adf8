"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bourselake.llm import (
    op1_simhash,
    op2_language_id,
    op3_mixing,
    op4_licenses,
    op5_minhash,
    op6_pii,
    op7_exact_dedup,
    op8_ppm,
    op9_quality,
    op10_packing,
    op11_merkle,
    op12_signature_trees,
    op13_orchard,
)
from bourselake.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def _over_documents(build: Callable[[SparkSession, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(spark, documents(spark, sf_dir))


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return op9_quality.query(spark, documents(spark, sf_dir), labels)


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")


QUERIES: dict[str, Query] = {
    "op1_simhash_near_dedup": _over_documents(op1_simhash.query),
    "op2_language_id": _over_documents(op2_language_id.query),
    "op3_source_mixing": _over_documents(op3_mixing.query),
    "op4_license_scan": _over_documents(op4_licenses.query),
    "op5_minhash_fingerprints": _over_documents(op5_minhash.query),
    "op6_personal_data": _over_documents(op6_pii.query),
    "op7_exact_dedup": _over_documents(op7_exact_dedup.query),
    "op8_ppm_scores": _over_documents(op8_ppm.query),
    "op9_quality_classifier": _quality,
    "op10_best_fit_packing": _over_documents(op10_packing.query),
    "op11_merkle_manifest": _over_documents(op11_merkle.query),
    "op12_signature_trees": _over_documents(op12_signature_trees.query),
    "op13_orchard_codes": lambda spark, sf_dir: op13_orchard.query(spark, _embeddings(spark, sf_dir)),
}

ORACLES: dict[str, str] = {
    "op3_source_mixing": op3_mixing.ORACLE,
    "op7_exact_dedup": op7_exact_dedup.ORACLE,
    "op11_merkle_manifest": op11_merkle.ORACLE,
    "op12_signature_trees": op12_signature_trees.ORACLE,
    "op13_orchard_codes": op13_orchard.ORACLE,
}
