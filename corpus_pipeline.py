"""From raw documents to token ids: five stages, each an operator of ``fleetlens.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetlens.llm import decontaminate, exact_dedup, quality, sentencepiece, simhash
from fleetlens.llm.queries import PIECES
from fleetlens.session import materialize


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from these documents, does not reject."""
    return quality.keep_good(docs, quality.train(docs))


def exact_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal normalised text the one with the largest id."""
    return exact_dedup.keep_one(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id."""
    return simhash.keep_one(docs, shingle=3, distance=3)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less than a twentieth of whose words stand in benchmark windows."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document."""
    return sentencepiece.encode(docs, PIECES)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_deduplication", exact_deduplication),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece_encoding", sentencepiece_encoding),
]

#: The first stage learns a model, which SQL cannot express; the tests hold each stage against its own rule.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over the documents of ``sf_dir``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
