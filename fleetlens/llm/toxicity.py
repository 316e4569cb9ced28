"""Toxicity: a linear classifier on character n-grams that are scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm import features
from fleetlens.llm.memory import tidy
from fleetlens.llm.text import picked
from fleetlens.session import materialize

#: Labelled rows at most that the linear classifier is fitted on; the ratios count all labelled rows.
SAMPLE = 20_000
#: Characters of an n-gram (long ones hold the stem of a word), and bits of a bucket number.
ORDERS, BITS = (4, 6, 8), 21
#: An n-gram is a feature if it is in this many toxic documents or more and its log-count ratio is above this:
#: the many that tell nothing would hide the few that do, above all in languages with few labels.
LEAST, RATIO = 4, 0.7
#: How much more an error in a toxic document counts than one in a clean document, which are many.
COST = 4.0
#: Passes over the fitted rows, and the step.
ROUNDS, RATE = 12, 0.3
#: Labels are broadcast to the documents only if they take no more than this.
BROADCAST_BYTES, LABEL_BYTES = 32 << 20, 32
#: Buckets of one record batch of counts.
SLICE = 1 << 18


@dataclass
class Model:
    weight: np.ndarray
    bias: float
    chosen: np.ndarray


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, label: labelled documents, written once, since they are counted and then sampled.

    Small label tables are broadcast, others joined by a shuffle.
    """
    labels = labels.groupBy("doc_id").agg(F.max("label").alias("label"))
    if labels.count() * LABEL_BYTES <= BROADCAST_BYTES:
        labels = F.broadcast(labels)
    return materialize(docs.join(labels, "doc_id"), "toxicity-labelled")


def _counts(labelled: DataFrame) -> np.ndarray:
    """Per class and bucket, how many labelled documents have it; zero for buckets of fewer than ``LEAST`` toxic ones."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, counts = features.Buckets(ORDERS, BITS), np.zeros((2, 1 << BITS), np.int32)
        for part in parts:
            for label, data in zip(part["label"].to_pylist(), features.code_points(part["text"]), strict=True):
                counts[label][buckets(data)] += 1
        found = np.flatnonzero(counts.any(axis=0))
        for at in range(0, len(found), SLICE):
            here = found[at:at + SLICE]
            yield pa.RecordBatch.from_arrays(
                [pa.array(here, pa.int32()), pa.array(counts[0][here]), pa.array(counts[1][here])],
                ["bucket", "clean", "toxic"])

    table = labelled.select("label", "text").mapInArrow(tidy(batches), "bucket int, clean int, toxic int") \
        .groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")) \
        .filter(F.col("toxic") >= LEAST).toArrow()
    out = np.zeros((2, 1 << BITS))
    at = table["bucket"].to_numpy()
    out[0, at], out[1, at] = table["clean"].to_numpy(), table["toxic"].to_numpy()
    return out


def _scales(labelled: DataFrame) -> np.ndarray:
    """The log-count ratio of each feature: how much likelier a toxic document has it; zero for other buckets."""
    of = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    clean, toxic = _counts(labelled)
    ratio = np.log((toxic + 1) / (of.get(1, 0) + 2)) - np.log((clean + 1) / (of.get(0, 0) + 2))
    return np.where((toxic >= LEAST) & (ratio > RATIO), ratio, 0.0)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """A model learnt from the documents that ``labels`` marks 0 or 1.

    Other marks, null ids and documents without a mark are left out; of several marks of an id the larger
    counts. Repeated rows count as often as they are there, null and empty texts as documents without features.
    Texts of any length are read whole. Without labelled documents every score is the prior of one half. Ids are
    cast to long. Other columns are ignored.
    """
    marks = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")) \
        .filter("label IN (0, 1) AND doc_id IS NOT NULL")
    labelled = _labelled(picked(docs, id_col, text_col), marks)
    scale = _scales(labelled)
    chosen = scale > 0
    rows, target = features.bucket_rows(features.sampled(labelled, sample), "label", ORDERS, BITS, chosen)
    weight, bias = features.fit(rows, target, scale, ROUNDS, RATE, cost=np.where(target == 1, COST, 1.0))
    return Model(weight, bias, chosen)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 if score >= 0.5) per row, rows with null or repeated ids included.

    Null and empty texts, and those without a feature, get the prior. Texts of any length are read whole; an
    empty table gives an empty one.
    """
    return features.scored(picked(docs, id_col, text_col), model.weight, model.bias, ORDERS, BITS, model.chosen) \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
