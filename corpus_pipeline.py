"""The corpus pipeline: each stage's rows, written as Parquet, are the next one's documents.

toxicity -> exact dedup -> near-duplicate dedup -> mixing to target weights -> packing.
All stages but the last return the columns of ``documents``; the last returns one
row per packed piece.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from netpulse.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from netpulse.llm.catalog import public_vocabulary, topics
from netpulse.llm.common import read, stage

# Least shingle similarity in percent of documents of which the pipeline keeps one; op10_near_dedup has its own.
NEAR_PERCENT = 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go; the model is fitted on all labelled documents of the stage's input."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    return exact_dedup.without_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays."""
    return near_dedup.without_near_copies(docs, NEAR_PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics meet their targets."""
    return mixing.sample_mixture(docs, topics(spark, sf_dir))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its sequence and place."""
    return packing.pack(packing.token_pieces(docs, *public_vocabulary()))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Toxicity is a fitted model and near duplicates are found by hashing: SQL cannot express the rows.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each reread from what the one before wrote."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
