"""From raw documents to shards: toxicity, near duplicates, benchmark passages, source weights, shards."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lamella.llm import decontamination, mixing, ngram_join, sharding, toxicity  # noqa: E402
from lamella.llm.common import documents, staged  # noqa: E402

SHARDS = 16


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier rejects; it is fitted on labelled rows of the training folds."""
    model = toxicity.fit(documents(spark, sf_dir), documents(spark, sf_dir, "labels"), keep=~toxicity.held_out())
    return toxicity.remove_toxic(docs, model)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that share at least 80 % of their five-word shingles."""
    return ngram_join.keep_one_of_each_group(docs, n=5, percent=80)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a test item."""
    return decontamination.remove_leaks(docs, documents(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for."""
    return mixing.mix(docs, weights=(3, 1, 2), share=1.5, epochs=2.0)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard of each document, by its id."""
    return sharding.assign_shards(docs, SHARDS)


STAGES = [
    ("toxicity", remove_toxic), ("ngram_join", remove_near_duplicates), ("decontamination", remove_benchmark),
    ("mixing", mix_sources), ("sharding", shard),
]

# A classifier and a component search cannot be written in SQL; tests compare the pipeline with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
