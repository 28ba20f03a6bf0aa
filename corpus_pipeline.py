"""A training corpus from the documents table: filter, deduplicate, mix, pack."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeflow.llm import mixing, packing, quality, simhash, suffixes
from gradeflow.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Shares of tokens in the corpus: documents that are not toxic, and toxic ones, which go.
TARGETS = (1.0, 0.0)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current quality policy keeps."""
    return quality.accepted(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of near copies."""
    return simhash.one_per_group(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 50 words or more that an earlier document (or place) has."""
    return suffixes.cleaned(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix asks for.

    The mix keeps the number of tokens: toxic documents make room for the others. Those
    that are mainly toxic all go; those that are mainly not toxic all stay, once at least.
    """
    labels = table(spark, sf_dir, "labels").select("doc_id", F.expr("CASE WHEN toxic IN (0, 1) THEN toxic END").alias("domain"))
    return mixing.resampled(docs, labels, list(TARGETS), keep=[0])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the corpus and their places in sequences."""
    return packing.packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

#: Tokenizers and the packing are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage; what a stage returns is stored before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
