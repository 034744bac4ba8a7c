"""From documents to packed training sequences, in stages that are each written and read again.

STAGES: (name, function); a function takes (spark, docs, sf_dir) and returns the next stage's docs with the columns of
documents, the last one pieces of sequences. run() applies them to the documents of a folder of tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskstream.llm import exact, mixing, packing, quality, simhash
from riskstream.llm.common import written


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from the labels that are not held out."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, model)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.deduplicate(docs)


def dissimilar_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates."""
    return simhash.keep_one(docs)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for."""
    return mixing.mix(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, packed into sequences."""
    return packing.packing_digest(packing.pack(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_documents),
    ("exact dedup", distinct_documents),
    ("SimHash near-dedup", dissimilar_documents),
    ("mixing sources to target weights", mixed_documents),
    ("packing", sequences),
]

#: A fitted model and fingerprints are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = written(docs, f"stage-{place}")
    return docs
