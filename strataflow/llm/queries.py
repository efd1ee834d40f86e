"""The operators' queries: each over its whole table, with production parameters, returning its full result."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from strataflow.llm import (
    bpe_codec,
    collocations,
    hilbert_shards,
    packing_gga,
    paragraph_dedup,
    pii,
    quality_qda,
    quality_rules,
    simhash_anchor,
    source_divergence,
    suffix_dedup,
    token_binary,
    topk_nra,
)
from strataflow.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def ready(spark: SparkSession) -> None:
    """Python workers of this machine find the package, wherever the session was started from."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def query(f: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ready(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


@query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_qda.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.round_trip(table(spark, sf_dir, "documents"), "byte_bpe_multi_50k.tiktoken")


@query
def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_nra.top_k(table(spark, sf_dir, "embeddings"))


@query
def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(table(spark, sf_dir, "documents"))


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_gga.pack_documents(table(spark, sf_dir, "documents"), "byte_bpe_50k.json")


@query
def op7_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_binary.write_and_read(table(spark, sf_dir, "documents"), "byte_bpe_50k.json")


@query
def op8_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_dedup.cut_paragraphs(table(spark, sf_dir, "documents"))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_anchor.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents"))


@query
def op12_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards.shards_of(table(spark, sf_dir, "documents"))


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))
