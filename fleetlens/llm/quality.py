"""Quality from weak labels: heuristic labellers vote, expectation-maximisation weighs them, a scorer learns.

No hand-made label is used. Each labeller says good, bad or nothing about a document from one simple figure.
How far each can be trusted is estimated from how often they agree, over the vote patterns of all documents;
the estimated labels of a bounded sample then train a linear scorer on hashed n-grams.
"""

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

#: Documents at most that the linear scorer is fitted on.
SAMPLE = 5000
BAD, GOOD, NONE = 0, 1, 2
#: Frequent short words of the languages of the corpus: a choice of this module.
FUNCTION_WORDS = frozenset("the of and to in is a that for with de la le et les des du der die das und in den von "
                           "el los las y en que por un una ein eine il".split())
SYMBOLS = np.frombuffer(b"#$%&*|{}<>=~^_\\+@", np.uint8)
LABELLERS = ("symbols", "capitals", "variety", "function_words", "sentences", "shouting", "word_length")


def votes(text: str) -> list[int]:
    """What each labeller says. A text without words is bad to those that count words."""
    raw = np.frombuffer(text.encode(), np.uint8)
    count = np.bincount(raw, minlength=256)
    words = text.split()
    n, size = max(len(words), 1), max(len(raw), 1)
    letters = max(count[65:91].sum() + count[97:123].sum() + count[128:].sum(), 1)

    def between(value: float, bad: float, good: float) -> int:
        """Good on the one side of ``good``, bad on the other side of ``bad``."""
        if bad > good:
            return BAD if value >= bad else GOOD if value <= good else NONE
        return BAD if value <= bad else GOOD if value >= good else NONE

    stops = (count[ord(".")] + count[ord("!")] + count[ord("?")]) / n
    return [
        between(count[SYMBOLS].sum() / size, 0.04, 0.02),
        between(count[65:91].sum() / letters, 0.3, 0.12),
        between(len(set(words)) / n, 0.25, 0.4) if len(words) >= 20 else NONE if words else BAD,
        between(sum(w.strip(".,").lower() in FUNCTION_WORDS for w in words) / n, 0.08, 0.15),
        NONE if 0.3 > stops > 0.15 else BAD if stops >= 0.3 or stops < 0.01 else GOOD,
        between(count[ord("!")] / n, 0.1, 0.03) if words else BAD,
        between(sum(map(len, words)) / n, 14.0, 9.0) if words else BAD,
    ]


def vote_patterns(docs: DataFrame) -> DataFrame:
    """doc_id, pattern (the votes as digits) for each row of a table with columns doc_id, text."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = ["".join(map(str, votes(x or ""))) for x in part["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(found, pa.string())], ["doc_id", "pattern"])

    return docs.select("doc_id", "text").mapInArrow(tidy(batches), "doc_id long, pattern string")


def weigh(patterns: dict[str, int], rounds: int = 200) -> tuple[dict[str, float], np.ndarray]:
    """Probability of good per vote pattern, and each labeller's estimated probabilities (class, vote).

    Each labeller has its own probabilities of saying bad, good or nothing about documents of either class;
    votes are independent within a class. Starts from the share of good votes, so the classes keep their
    names.
    """
    names = sorted(patterns)
    if not names:
        return {}, np.zeros((0, 2, 3))
    said = np.array([[int(c) for c in p] for p in names])
    weight = np.array([patterns[p] for p in names], float)
    good = (1.0 + (said == GOOD).sum(axis=1)) / (2.0 + (said != NONE).sum(axis=1))
    table = np.zeros((said.shape[1], 2, 3))
    for _ in range(rounds):
        share = np.stack([1 - good, good]) * weight
        for k in range(said.shape[1]):
            for vote in (BAD, GOOD, NONE):
                table[k, :, vote] = share[:, said[:, k] == vote].sum(axis=1) + 1.0
        table /= table.sum(axis=2, keepdims=True)
        prior = (share.sum(axis=1) + 1) / (weight.sum() + 2)
        log = np.log(prior)[:, None] + sum(np.log(table[k][:, said[:, k]]) for k in range(said.shape[1]))
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
        done, good = np.abs(new - good).max() < 1e-9, new
        if done:
            break
    return dict(zip(names, good.tolist(), strict=True)), table


@dataclass
class Model:
    weight: np.ndarray
    bias: float
    posterior: dict[str, float]
    labellers: np.ndarray


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model:
    """Labellers weighed on all documents; a scorer fitted on ``sample`` of them at most, by hash of the id.

    Null texts count as empty; rows with a null id vote but are not sampled. Other columns are ignored. Without
    documents every score is one half.
    """
    table = picked(docs, id_col, text_col)
    counts = {r["pattern"]: r["count"] for r in  # three to the power of the labellers at most
              vote_patterns(table).groupBy("pattern").count().collect()}
    posterior, labellers = weigh(counts)

    def good(text: str) -> float:
        return posterior.get("".join(map(str, votes(text))), 0.5)

    rows, target = features.bucket_rows(features.sampled(table, sample), good)
    return Model(*features.fit(rows, target, np.ones(1 << features.BITS)), posterior, labellers)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (probability of good) and keep (score >= 0.5), one row per row of ``docs``.

    Null and empty texts get the scorer's prior.
    """
    return features.scored(picked(docs, id_col, text_col), model.weight, model.bias) \
        .withColumn("keep", F.col("score") >= 0.5)


def keep_good(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the scorer keeps, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weight.astype(np.float32), model.bias))
    at = docs.columns.index(text_col)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, (weight, bias) = features.Buckets(), shared.value
        for part in parts:
            good = [features.score(buckets(x), weight, bias) >= 0.5 for x in features.code_points(part.column(at))]
            yield part.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(tidy(batches), docs.schema)
