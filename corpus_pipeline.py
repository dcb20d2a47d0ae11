"""The corpus pipeline: documents in, packed training sequences out."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tradelake.llm import language, lsh_forest, mixing, packing, quality  # noqa: E402
from tradelake.llm.common import table, written  # noqa: E402

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.good_documents(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return language.recognised(docs, language.fit(docs))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return lsh_forest.without_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    # The workers of earlier stages live on, so this one remembers fewer words.
    return packing.pack_documents(docs, remembered=150_000)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good),
    ("language ID", in_a_language),
    ("n-gram Jaccard join", without_near_copies),
    ("mixing sources to target weights", mixed),
    ("best-fit packing", packed),
]

#: Models, hashes and tokens cannot be expressed in SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
