"""A corpus pipeline: drop poor documents, keep one of each near-duplicate group, cut repeats, mask personal data, pack.

``run`` applies the stages in order to ``documents``. Each stage's rows are written to the
shared scratch folder and read again, so a lost executor repeats one stage's tasks only.
All but the last return the columns of ``documents``; texts change only in stages 3 and 4.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataflow.llm import packing_gga, pii, quality_qda, simhash_anchor, suffix_dedup
from strataflow.llm.common import stored, table
from strataflow.llm.queries import ready


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of at least 0.3 stay."""
    ready(spark)
    return quality_qda.keep_good(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: that with the smallest doc_id."""
    ready(spark)
    return simhash_anchor.keep_first(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose every byte covered by a 50-byte string of a document with a smaller doc_id; emptied documents go."""
    ready(spark)
    return suffix_dedup.keep_text(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind."""
    ready(spark)
    return pii.mask(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of at most 1024 tokens."""
    ready(spark)
    return packing_gga.pack_documents(docs, "byte_bpe_50k.json")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: A fitted classifier, components and a genetic algorithm: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
