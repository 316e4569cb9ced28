"""Removal of repeated passages by relative Lempel-Ziv parsing.

The reference of a document is all documents with smaller ids. It is indexed in shards by its windows of
words, and a document is factored greedily from left to right: a factor goes on as long as the same reference
document continues it. Every window is looked up for itself, also those that straddle the end of a factor, so
that a change of reference hides nothing. Factors of at least a window are duplicate spans.

Most text occurs once, so the index is built in two steps: each window has a leading word group (the one with
the least hash inside it); only windows whose leading group stands in more than one document are indexed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.blocks import ASK_DDL, answered, ask_rows, gathered, in_order, shard_count, spread, word_hashes, write_blocks
from fleetlens.llm.memory import tidy

WINDOW, GROUP = 50, 16
#: Odd multipliers of the two window hashes.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
NO_ID = np.iinfo(np.int64).min


def _rolling(hashes: np.ndarray, length: int, base: int) -> np.ndarray:
    """Hash of each span of ``length`` words, from prefix sums modulo 2^64."""
    if len(hashes) < length:
        return np.empty(0, np.uint64)
    power = np.full(len(hashes), base, np.uint64)
    power[0] = 1
    power = np.cumprod(power)
    inverse = np.full(len(hashes), pow(base, -1, 1 << 64), np.uint64)
    inverse[0] = 1
    inverse = np.cumprod(inverse)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * power)])
    out = (total[length:] - total[:-length]) * inverse[:len(hashes) - length + 1]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:len(out) - step], out[step:])
        done += step
    return out


class _Block:
    """The windows of a block: where they start, their documents and leading groups."""

    def __init__(self, doc_ids: pa.Array, texts: pa.Array, window: int):
        group = min(GROUP, window)
        self.ids = pc.fill_null(doc_ids, NO_ID).to_numpy(zero_copy_only=False)
        codes, self.n_words, hashes = word_hashes(texts, lower=False)
        self.words = hashes[codes] if len(codes) else np.empty(0, np.uint64)
        self.doc = np.repeat(np.arange(len(self.ids)), self.n_words)
        self.first = np.cumsum(self.n_words) - self.n_words
        inside = np.arange(len(codes)) + window <= (self.first + self.n_words)[self.doc]
        self.starts = np.flatnonzero(inside)
        lead = _least(_rolling(self.words, group, BASES[0]), window - group + 1) if len(codes) >= window else np.empty(0, np.uint64)
        self.lead = lead[self.starts]
        self.window = window

    def groups(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct leading groups, least and largest id of their documents, and the group of each window."""
        found, of_window = np.unique(self.lead, return_inverse=True)
        ids = self.ids[self.doc[self.starts]]
        low, high = np.full(len(found), np.iinfo(np.int64).max), np.full(len(found), NO_ID)
        np.minimum.at(low, of_window, ids)
        np.maximum.at(high, of_window, ids)
        return found, low, high, of_window

    def windows(self, picked: np.ndarray) -> tuple[np.ndarray, ...]:
        """Both hashes and least id of the distinct windows among those picked, and which one each is."""
        at = self.starts[picked]
        one, two = (_rolling(self.words, self.window, base)[at] if len(at) else np.empty(0, np.uint64) for base in BASES)
        ids = self.ids[self.doc[at]]
        order = np.lexsort((ids, two, one))
        a, b = one[order], two[order]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.empty(0, bool)
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        return a[new], b[new], ids[order][new], which


def _shared(told: list[list[np.ndarray]], shard: int) -> list[list[np.ndarray]]:
    """Whether each group stands in more than one document."""
    group, low, high = (np.concatenate([t[k] for t in told]).astype(d) for k, d in enumerate((np.uint64, np.int64, np.int64)))
    found, which = np.unique(group, return_inverse=True)
    least, most = np.full(len(found), np.iinfo(np.int64).max), np.full(len(found), NO_ID)
    np.minimum.at(least, which, low)
    np.maximum.at(most, which, high)
    flags = (least < most)[which].astype(np.uint8)
    return [[x] for x in np.split(flags, np.cumsum([len(t[0]) for t in told])[:-1])]


def _least_ids(told: list[list[np.ndarray]], shard: int) -> list[list[np.ndarray]]:
    """The least document id of each window, told apart by both hashes."""
    one, two, ids = (np.concatenate([t[k] for t in told]).astype(d) for k, d in enumerate((np.uint64, np.uint64, np.int64)))
    order = np.lexsort((ids, two, one))
    a, b = one[order], two[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    out = np.empty(len(order), np.int64)
    out[order] = ids[order][new][np.cumsum(new) - 1]
    return [[x] for x in np.split(out, np.cumsum([len(t[0]) for t in told])[:-1])]


def _rows(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Block rows; the two long columns stay Arrow arrays."""
    for part in parts:
        rest = [c for c in part.schema.names if c not in ("doc_ids", "texts")]
        for k in range(part.num_rows):
            yield {"doc_ids": part["doc_ids"][k].values, "texts": part["texts"][k].values,
                   **{c: part[c][k].as_py() for c in rest}}


def _factors(start: np.ndarray, reference: np.ndarray, window: int) -> list[dict]:
    """Greedy factors: runs of repeated windows that one reference document continues."""
    if not len(start):
        return []
    new = np.concatenate([[True], (start[1:] != start[:-1] + 1) | (reference[1:] != reference[:-1])])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return [{"start": a, "length": b - a + window, "reference": r if r != NO_ID else None}
            for a, b, r in zip(start[first].tolist(), start[last].tolist(), reference[first].tolist(), strict=True)]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   with_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256, factors (start, length, reference).

    Words are runs of other than ASCII white space. Each word covered by a window of ``window`` words that also
    starts in a document with a smaller id is removed; windows are judged on the input. ``factors`` are the
    repeated spans by word number, with the least id that holds their windows. ``with_text`` adds ``kept``, the
    kept words joined by a space. Null and empty texts have no words. A null id is smaller than any other; rows
    with equal ids do not count as each other's reference. Rows come back as often as they are there; other
    columns are ignored. Windows are told apart by two 64-bit hashes.
    """
    table = write_blocks(docs, id_col, text_col)
    shards = shard_count(table)

    def ask_groups(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(parts):
            found, low, high, _ = _Block(row["doc_ids"], row["texts"], window).groups()
            yield ask_rows(row["block"], spread(found, shards), [found, low, high])[0]

    def picked_windows(row: dict) -> tuple[_Block, np.ndarray, tuple[np.ndarray, ...]]:
        block = _Block(row["doc_ids"], row["texts"], window)
        found, _, _, of_window = block.groups()
        flags, = in_order(row["shared"], np.argsort(spread(found, shards), kind="stable"), 1)
        picked = np.flatnonzero(flags[of_window]) if len(found) else np.empty(0, np.int64)
        return block, picked, block.windows(picked)

    def ask_windows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(parts):
            _, _, (one, two, ids, _) = picked_windows(row)
            yield ask_rows(row["block"], spread(one, shards), [one, two, ids])[0]

    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "factors"] + ["kept"] * with_text
    factor = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("reference", pa.int64())])
    schema = pa.schema(list(zip(names, [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(factor), pa.string()])))

    def parse(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(parts):
            block, picked, (one, _, _, which) = picked_windows(row)
            least, = in_order(row["least"], np.argsort(spread(one, shards), kind="stable"), 1)
            reference = least[which] if len(which) else np.empty(0, np.int64)
            at = block.starts[picked]
            repeated = reference < block.ids[block.doc[at]]
            at, reference = at[repeated], reference[repeated]
            cover = np.zeros(len(block.words) + 1, np.int64)
            np.add.at(cover, at, 1)
            np.add.at(cover, at + window, -1)
            gone = np.cumsum(cover[:-1]) > 0
            bounds = np.searchsorted(at, np.append(block.first, len(block.words)))
            out = []
            for k, (doc_id, text) in enumerate(zip(row["doc_ids"].to_pylist(), row["texts"], strict=True)):
                a, n = int(block.first[k]), int(block.n_words[k])
                words = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(text)).values if n else pa.array([], pa.string())
                removed = gone[a:a + n]
                kept = " ".join((words.filter(pa.array(~removed)) if removed.any() else words).to_pylist())
                found = slice(bounds[k], bounds[k + 1])
                out.append([doc_id, n, int(removed.sum()), hashlib.sha256(kept.encode()).hexdigest(),
                            _factors(at[found] - a, reference[found], window), kept][:len(names)])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    texts = table.select("block", "doc_ids", "texts")
    shared = gathered(answered(texts.mapInArrow(tidy(ask_groups), ASK_DDL), _shared), "shared")
    with_shared = texts.join(shared, "block", "left")
    least = gathered(answered(with_shared.mapInArrow(tidy(ask_windows), ASK_DDL), _least_ids), "least")
    ddl = ("doc_id long, n_words long, n_removed long, kept_sha256 string, "
           "factors array<struct<start:long,length:long,reference:long>>" + ", kept string" * with_text)
    return with_shared.join(least, "block", "left").mapInArrow(tidy(parse), ddl)
