"""The corpus pipeline: raw documents to token ids, stage by stage.

Each stage works on what its predecessor kept and is written before the next
one reads it. Stages but the last keep the columns of documents. Files may be
read back in any order, so the last stage gives the order as columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakewarden.llm import byte_bpe, exact_dedup, mixing, near_copies, toxicity
from lakewarden.llm.common import settle, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on labels outside the held-out part, does not reject."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest doc_id."""
    return exact_dedup.keep_first(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that similarity 0.8 or more of five-word shingles links the one with the smallest doc_id.

    SimHash links first, verified on the shingles; the shingles themselves find what is farther apart.
    """
    return near_copies.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in an order that holds the sources' target weights throughout."""
    return mixing.mixed_order(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, checked by decoding them, with slot and offset: its place in the mixture."""
    return byte_bpe.tokenised(mixing.placed(docs), byte_bpe.production(spark), ["slot", "offset"])


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("near_copies", without_near_copies),
    ("mixing", mixed),
    ("byte_bpe", encoded),
]

ORACLE_SQL = None  # labels models, fingerprints and tokens are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
