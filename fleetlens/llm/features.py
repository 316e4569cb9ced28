"""Hashed character n-grams and a logistic regression on them.

Only bounded samples are fitted; counts and scores run over all rows on the executors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.memory import tidy

#: Characters of an n-gram, and bits of a bucket number.
ORDERS, BITS = (3, 4, 5), 18


def code_points(texts: pa.Array) -> list[np.ndarray]:
    """Code points of each text, with A-Z in lower case and a space around; null counts as empty."""
    low = pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), "")).to_pylist()
    return [np.frombuffer(f" {text} ".encode("utf-32-le"), np.uint32) if text else np.empty(0, np.uint32)
            for text in low]


class Buckets:
    """Distinct buckets of the n-grams of a text, of the ``chosen`` ones (a flag per bucket) if given.

    The scratch table is used again for each text.
    """

    def __init__(self, orders: tuple[int, ...] = ORDERS, bits: int = BITS, chosen: np.ndarray | None = None):
        self.orders, self.bits, self.chosen = orders, bits, chosen
        self.last = np.zeros(1 << bits, np.int32)

    def __call__(self, data: np.ndarray) -> np.ndarray:
        found, value = [], np.zeros(len(data) + 1, np.uint32)
        for order in range(1, max(self.orders) + 1):
            if len(data) < order:
                break
            value = value[:-1] * np.uint32(0x01000193) + data[order - 1:] + np.uint32(1)
            if order in self.orders:
                mixed = (value ^ (value >> np.uint32(15)) ^ np.uint32(order * 0x1ED270B)) * np.uint32(0x9E3779B1)
                bucket = mixed >> np.uint32(32 - self.bits)
                found.append(bucket if self.chosen is None else bucket[self.chosen[bucket]])
        if not found:
            return np.empty(0, np.uint32)
        bucket = np.concatenate(found)
        place = np.arange(len(bucket), dtype=np.int32)
        self.last[bucket] = place
        return bucket[self.last[bucket] == place]


def fit(rows: list[np.ndarray], target: np.ndarray, scale: np.ndarray, rounds: int = 4, rate: float = 0.1,
        seed: int = 7, cost: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights (one per bucket) and bias of a logistic regression on bounded rows.

    A row is its distinct buckets, each ``scale`` of the bucket, divided by the root of their number. ``target``
    holds probabilities, ``cost`` how much an error in a row counts (1 if not given). Stochastic gradient steps in a fixed order, shorter for buckets that have moved much;
    the weights of the later half of the rounds are averaged.
    """
    weight, moved, mean = (np.zeros(len(scale)) for _ in range(3))
    cost = np.ones(len(rows)) if cost is None else cost
    bias = float(np.log((target.sum() + 1) / (len(target) - target.sum() + 1)))
    mean_bias, bias_moved, draw = 0.0, 1e-8, np.random.default_rng(seed)
    moved += 1e-8
    counted = range(rounds - rounds // 2, rounds)
    for n in range(rounds):
        for k in draw.permutation(len(rows)).tolist():
            row = rows[k]
            value = scale[row] / np.sqrt(max(len(row), 1))
            margin = bias + value @ weight[row]
            error = cost[k] * (1 / (1 + np.exp(-np.clip(margin, -50, 50))) - target[k])
            gradient = error * value
            moved[row] += gradient * gradient
            weight[row] -= rate * gradient / np.sqrt(moved[row])
            bias_moved += error * error
            bias -= rate * error / np.sqrt(bias_moved)
        if n in counted:
            mean += weight / len(counted)
            mean_bias += bias / len(counted)
    return mean * scale, mean_bias if len(rows) else bias


def sampled(docs: DataFrame, most: int) -> DataFrame:
    """The rows of ``docs`` (columns doc_id, ...) with the ``most`` least hashes of their ids; null ids are left out.

    Rows with equal ids share a hash, so repeated rows may add to ``most``.
    """
    hashed = docs.withColumn("draw", F.xxhash64("doc_id")).filter("doc_id IS NOT NULL")
    least = hashed.select("draw").distinct().orderBy("draw").limit(most).agg(F.max("draw")).first()[0]
    return hashed.filter(F.col("draw") <= F.lit(least)).drop("draw") if least is not None else docs.limit(0)


def bucket_rows(docs: DataFrame, target: str | Callable[[str], float], orders: tuple[int, ...] = ORDERS,
                bits: int = BITS, chosen: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Buckets and target of each row of a bounded table with columns doc_id, text, on the driver.

    The target is a column, or worked out from the text in the same pass, so a task needs one Python worker.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chosen)  # a byte a bucket

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets(orders, bits, shared.value)
        for part in parts:
            found = [buckets(x).astype(np.int32) for x in code_points(part["text"])]
            aims = part["target"] if isinstance(target, str) else pa.array(
                [target(x or "") for x in part["text"].to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([part["doc_id"], aims, pa.array(found, pa.list_(pa.int32()))],
                                             ["doc_id", "target", "buckets"])

    known = [F.col(target).cast("double").alias("target")] if isinstance(target, str) else []
    made = docs.select("doc_id", "text", *known) \
        .mapInArrow(tidy(batches), "doc_id long, target double, buckets array<int>").orderBy("doc_id").toArrow()
    rows = [x.values.to_numpy() for x in made["buckets"].combine_chunks()] if made.num_rows else []
    return rows, made["target"].to_numpy().astype(float)


def scored(docs: DataFrame, weight: np.ndarray, bias: float, orders: tuple[int, ...] = ORDERS,
           bits: int = BITS, chosen: np.ndarray | None = None) -> DataFrame:
    """doc_id, score for each row of ``docs`` (columns doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast((weight.astype(np.float32), bias, chosen))  # five bytes a bucket

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, start, flags = shared.value
        buckets = Buckets(orders, bits, flags)
        for part in parts:
            found = [score(buckets(x), weights, start) for x in code_points(part["text"])]
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(found, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(tidy(batches), "doc_id long, score double")


def score(bucket: np.ndarray, weight: np.ndarray, bias: float) -> float:
    """Probability that a text with these buckets is of class 1."""
    margin = bias + (weight[bucket].sum() / np.sqrt(len(bucket)) if len(bucket) else 0.0)
    return float(1 / (1 + np.exp(-np.clip(margin, -500, 500))))
