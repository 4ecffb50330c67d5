"""From raw documents to a training mix; each stage is one of the operators in ``daybook.llm``."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from threading import local

from pyspark.sql import DataFrame, SparkSession

from daybook.llm import exact_tree, mil, partenum, pivotal, spaced_seed
from daybook.llm.stage import cut, drop, recording, table

#: Intermediate tables of the last stage that a thread ran. Once its next one begins, the result is
#: written, and nothing reads them any more. Pipelines of different threads leave each other's alone.
_left = local()


def _stage(function: Callable) -> Callable:
    @wraps(function)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop(spark, vars(_left).pop("tables", []))
        with recording() as made:
            kept = function(spark, docs, sf_dir)
        _left.tables = made
        return kept

    return stage


@_stage
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on labelled ones among ``docs``, predicts good."""
    return mil.keep_good(docs, table(spark, sf_dir, "labels"))


@_stage
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    return exact_tree.keep_distinct(docs)


@_stage
def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest doc_id. As a near-duplicate stage it
    takes five words and a similarity of 0.8."""
    return partenum.keep_one(docs, shingle=5, percent=80)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with the benchmark."""
    return spaced_seed.keep_clean(docs, table(spark, sf_dir, "benchmark"))


@_stage
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, and how often."""
    return pivotal.take_mix(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", decontamination),
    ("mixing sources", source_mix),
]

#: Training, hashing and random rounding have no SQL; the tests hold every stage against plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs
