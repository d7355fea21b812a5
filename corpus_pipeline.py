"""Corpus pipeline: language, exact copies, near copies, mixture, sequences.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All stages but
the last return the columns of ``documents``:

* language: documents whose language can't be told go;
* exact_copies: one document of each group of equal texts stays;
* near_copies: one document of each component of similar texts stays;
* mixture: documents repeat by their source's weight, none is left out;
* sequences: the remaining documents as packed token sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daybook.llm import exact_dedup, jaccard_join, language_id, mixing, packing
from daybook.llm.common import materialise, table
from daybook.llm.queries import MIX_ENTROPY, MIX_EPOCHS, vocabulary


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.accepted(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_per_group(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, target_entropy=MIX_ENTROPY, max_epochs=MIX_EPOCHS)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary())


STAGES = [
    ("language", language),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("mixture", mixture),
    ("sequences", sequences),
]

# Language identification and tokenisation are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
