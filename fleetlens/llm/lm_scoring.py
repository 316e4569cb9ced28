"""Scores of an n-gram language model kept in Elias-Fano tries.

Training counts are gathered from the whole corpus, sharded by context. A shard keeps its n-grams in a trie
of monotone sequences: contexts, pointers to the first successor of each, and successors whose numbers are
relative to their context, all in Elias-Fano code, with a quantised smoothed probability for each successor.
The levels lie in one file that the task maps into memory. Before the look-up they are decoded into plain arrays,
on which an n-gram is found by a successor search among the numbers relative to its context; only the codes of
the probabilities stay mapped. Single words are neither in a trie nor quantised. Documents are scored in blocks that ask once for each distinct n-gram.
"""

from __future__ import annotations

import tempfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.blocks import ASK_DDL, LEAST_SHARDS, answered, ask_rows, gathered, in_order, packed, spread, unpacked, word_hashes
from fleetlens.llm.memory import tidy
from fleetlens.session import materialize

#: Identifier of the end of a text, which also stands before its first word.
END_HASH = np.uint64(0x2545F4914F6CDD1D)
#: Largest weight of the distribution without context.
MOST_BACKOFF = 0.95
#: Contexts are classed by the binary logarithm of their count.
CLASSES = 64
#: Quantised probabilities: steps of the logarithm; 0 means that the n-gram was not seen.
STEP = 0.002
#: Words after which a block ends, and words per shard.
BLOCK_WORDS, SHARD_WORDS = 1 << 20, 1 << 20


# --- Elias-Fano ------------------------------------------------------------------------------

def elias_fano(values: np.ndarray) -> bytes:
    """A sequence of uint64 that never falls: low bits as they are, high bits in unary."""
    n, last = len(values), int(values[-1]) if len(values) else 0
    low = max(0, (last // n).bit_length() - 1) if n else 0
    bits = np.empty((n, low), np.uint8)
    for k in range(low):
        bits[:, k] = (values >> np.uint64(k)) & np.uint64(1)
    ones = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    unary = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
    unary[ones] = 1
    packed_low, packed_high = np.packbits(bits.ravel()), np.packbits(unary)
    head = np.array([n, low, len(packed_low), len(packed_high)], np.int64)
    return head.tobytes() + packed_low.tobytes() + packed_high.tobytes()


def elias_fano_decode(data: np.ndarray, at: int) -> tuple[np.ndarray, int]:
    """The sequence at byte ``at`` of a mapped file, and where it ends."""
    n, low, n_low, n_high = np.frombuffer(data[at:at + 32].tobytes(), np.int64).tolist()
    at += 32
    bits = np.unpackbits(data[at:at + n_low], count=n * low).reshape(n, low) if low else np.zeros((n, 0), np.uint8)
    at += n_low
    ones = np.flatnonzero(np.unpackbits(data[at:at + n_high]))
    out = (ones - np.arange(n)).astype(np.uint64) << np.uint64(low)
    for k in range(low):
        out |= bits[:, k].astype(np.uint64) << np.uint64(k)
    return out, at + n_high


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where a new value begins."""
    if not len(sorted_values):
        return np.empty(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))


def build_trie(context: np.ndarray, word: np.ndarray, code: np.ndarray) -> bytes:
    """The levels of a shard, from n-grams sorted by context and word."""
    first = _runs(context)
    ends = np.append(first[1:], len(context)).astype(np.int64)
    widths = word[ends - 1] + np.uint64(1) if len(first) else np.empty(0, np.uint64)
    base = np.cumsum(widths) - widths
    successors = np.repeat(base, ends - first) + word
    levels = [elias_fano(context[first]), elias_fano(np.concatenate([[0], ends]).astype(np.uint64)),
              elias_fano(base), elias_fano(successors)]
    return b"".join(levels) + code.astype("<u2").tobytes()


class Trie:
    """Levels of a mapped file, decoded one by one."""

    def __init__(self, data: np.ndarray):
        at = 0
        self.contexts, at = elias_fano_decode(data, at)
        self.pointers, at = elias_fano_decode(data, at)
        self.base, at = elias_fano_decode(data, at)
        self.successors, at = elias_fano_decode(data, at)
        self.codes = data[at:at + 2 * len(self.successors)].view("<u2")

    def look_up(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The code of each n-gram, 0 where there is none."""
        out = np.zeros(len(context), np.uint16)
        if not len(self.contexts):
            return out
        row = np.minimum(np.searchsorted(self.contexts, context), len(self.contexts) - 1)
        known = self.contexts[row] == context
        wanted = self.base[row] + word
        place = np.searchsorted(self.successors, wanted)
        inside = known & (place < self.pointers[row + 1].astype(np.int64))
        found = inside & (self.successors[np.minimum(place, len(self.successors) - 1)] == wanted)
        out[found] = self.codes[place[found]]
        return out


def quantised(probability: np.ndarray) -> np.ndarray:
    """Codes of probabilities, rounded down so that they never add up to more than they did."""
    steps = np.ceil(-np.log10(np.maximum(probability, 1e-130)) / STEP - 1e-9)
    return (1 + np.clip(steps, 0, 65534)).astype(np.uint16)


def probabilities(codes: np.ndarray) -> np.ndarray:
    table = np.concatenate([[0.0], 10.0 ** (-STEP * np.arange(65535))])
    return table[codes]


# --- Blocks of tokens ------------------------------------------------------------------------

def _planes(codes: np.ndarray) -> bytes:
    """Codes by byte planes, compressed: frequent words have small codes."""
    return zlib.compress(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _codes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _token_blocks(docs: DataFrame, id_col: str, text_col: str, learn: Column) -> DataFrame:
    """Documents in blocks of tokens, written once to the shared folder.

    ``codes`` are the words of the documents in turn by number in the block; ``hashes`` and ``counts`` say
    which word a number is and how often the block has it in documents that are learnt from. The last number
    stands for the end of a text.
    """
    schema = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.binary()),
                        ("learn", pa.binary()), ("codes", pa.binary()), ("words", pa.binary()), ("parts", pa.binary()), ("n_words", pa.int64())])

    def block_row(block: int, rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        ids, texts, learnt = (pa.chunked_array([r[c] for r in rows]).combine_chunks() for c in ("doc_id", "text", "learn"))
        codes, sizes, hashes = word_hashes(texts, lower=True)
        learnt = learnt.to_numpy(zero_copy_only=False).astype(bool)
        often = np.bincount(codes, minlength=len(hashes))
        order = np.argsort(-often, kind="stable")
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        codes, hashes = number[codes], np.append(hashes[order], END_HASH)
        counts = np.bincount(codes[np.repeat(learnt, sizes)], minlength=len(hashes))
        counts[-1] = learnt.sum()
        return pa.RecordBatch.from_pylist([{
            "block": block, "doc_ids": ids.to_pylist(), "sizes": sizes.tobytes(), "learn": learnt.tobytes(),
            "codes": _planes(codes), "words": packed([hashes, counts.astype(np.uint64)]),
            "parts": packed([_part(hashes)]), "n_words": len(codes)}], schema)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, rows, size = TaskContext.get().partitionId() << 32, [], 0
        for part in parts:
            for first in range(0, part.num_rows, 256):
                piece = part.slice(first, 256)
                rows.append(piece)
                size += piece["text"].nbytes
                if size >= BLOCK_WORDS * 6:
                    yield block_row(block, rows)
                    block, rows, size = block + 1, [], 0
        if rows:
            yield block_row(block, rows)

    flat = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.coalesce(learn, F.lit(False)).alias("learn"))
    return materialize(flat.mapInArrow(tidy(batches), "block long, doc_ids array<long>, sizes binary, learn binary, "
                                                "codes binary, words binary, parts binary, n_words long"), "token-blocks")


def _part(hashes: np.ndarray) -> np.ndarray:
    """What decides the shard of a word, as four bytes."""
    return (hashes.astype(np.uint64) >> np.uint64(32)).astype(np.uint32)


class _Tokens:
    """The tokens of a block with the global figures of its words."""

    def __init__(self, row: dict):
        self.sizes = np.frombuffer(row["sizes"], np.int64)
        words = _codes(row["codes"])
        asked, = unpacked(row["parts"])
        order = np.argsort(asked % row["shards"], kind="stable")
        count, number = in_order(row["known"], order, 2)
        self.count, self.number = count.astype(np.float64), number.astype(np.uint64)
        self.end = len(asked) - 1
        ends = np.cumsum(self.sizes)
        self.token = np.insert(words, ends, self.end)  # an end after the last word of each document
        self.before = np.concatenate([[self.end], self.token[:-1]])[:len(self.token)]
        self.document = np.repeat(np.arange(len(self.sizes)), self.sizes + 1)
        self.learn = np.frombuffer(row["learn"], bool)[self.document]

    def pairs(self) -> tuple[np.ndarray, ...]:
        """Distinct pairs of known words, how often the block teaches each, and the pair of each such token."""
        at = np.flatnonzero((self.count[self.before] > 0) & (self.count[self.token] > 0))
        wide = len(self.count)
        found, which = np.unique(self.before[at] * wide + self.token[at], return_inverse=True)
        taught = np.bincount(which, self.learn[at], len(found)).astype(np.uint64)
        return found // wide, found % wide, taught, at, which


def _in_runs(arrays: list[np.ndarray]) -> list[np.ndarray]:
    """Pairs, which come by context, with each context once."""
    context, word, taught, seen = arrays
    first = _runs(context)
    return [context[first], np.diff(np.append(first, len(context))).astype(np.uint64), seen[first], word, taught]


def _from_runs(arrays: list[np.ndarray]) -> list[np.ndarray]:
    context, size, seen, word, taught = arrays
    return [np.repeat(context, size.astype(np.int64)), word, taught, np.repeat(seen, size.astype(np.int64))]


def _pair_shards(context: np.ndarray, word: np.ndarray, seen: np.ndarray, total: int, shards: int) -> np.ndarray:
    """The shard of each pair: by context; contexts of a large share of the corpus are split by the word."""
    hot = seen > total / (4 * shards)
    mixed = context * np.uint64(0xD6E8FEB86659FD93)
    return spread(np.where(hot, mixed ^ (word * np.uint64(0x9E3779B97F4A7C15)), mixed), shards)


def _summary(answers: DataFrame, place: int, size: int) -> list[int]:
    """Sums of the figures that each shard has added, as array ``place``, to one of its answers."""
    def figures(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = [t[place].tolist() for t in map(unpacked, part["data"].to_pylist()) if len(t) > place]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(size), len(rows))),
                                                  pa.array(np.concatenate(rows).astype(np.int64))], ["figure", "value"])

    out = [0] * size
    for row in answers.select("data").mapInArrow(tidy(figures), "figure long, value long").groupBy("figure") \
            .agg(F.sum("value").alias("value")).collect():
        out[row["figure"]] = row["value"]
    return out


def _class(seen: np.ndarray) -> np.ndarray:
    """The class of contexts of these counts (at least 1)."""
    return np.floor(np.log2(np.maximum(seen, 1))).astype(np.int64)


def score_documents(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, learn, n_tokens, n_known, train_tokens, base_score, score for each row of ``docs``.

    A model of pairs of words is learnt from the rows for which ``learn`` holds and scores all rows. Words are
    runs of other than ASCII white space after lower-casing A-Z; each text ends with an end token, so null and
    empty texts have one token. ``score`` is the base ten logarithm of the text's probability: a pair's share
    among the successors of its context, interpolated with the share of the word, whose discount goes to words
    not seen. The weight of the latter is the part of singular pairs among contexts of like count. ``base_score`` is the sum over tokens of log10((c + 0.5) / (N + 0.5 (V + 1))). A null
    ``learn`` counts as false. Without rows to learn from, N and V are 0 and every token has probability 1.
    Repeated rows and rows with null ids count and come back like others; other columns are ignored. Words
    are told apart by a 64-bit hash.
    """
    blocks = _token_blocks(docs, id_col, text_col, learn)
    shards = max(LEAST_SHARDS, -(-(blocks.agg(F.sum("n_words")).first()[0] or 0) // SHARD_WORDS))

    def ask_words(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for block, words in zip(part["block"].to_pylist(), part["words"].to_pylist(), strict=True):
                hashes, counts = unpacked(words)
                yield ask_rows(block, (_part(hashes) % shards).astype(np.int32), [hashes, counts])[0]

    def number_words(told: list[list[np.ndarray]], shard: int) -> list[list[np.ndarray]]:
        hashes = np.concatenate([t[0].astype(np.uint64) for t in told])
        found, which = np.unique(hashes, return_inverse=True)
        count = np.bincount(which, np.concatenate([t[1] for t in told]), len(found)).astype(np.uint64)
        number = np.arange(len(found), dtype=np.uint64) * np.uint64(shards) + np.uint64(shard)
        cuts = np.cumsum([len(t[0]) for t in told])[:-1]
        answers = [list(x) for x in zip(np.split(count[which], cuts), np.split(number[which], cuts), strict=True)]
        answers[0].append(np.array([count.sum(), (count > 0).sum(), (count == 1).sum(), (count == 2).sum()], np.uint64))
        return answers

    asked = blocks.select("block", "words").mapInArrow(tidy(ask_words), ASK_DDL)
    known = materialize(answered(asked, number_words), "word-numbers")

    total, distinct, once, twice = _summary(known, 2, 4)
    discount = once / (once + 2 * twice) if once and twice else 0.5

    def token_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, _Tokens]]:
        for part in parts:
            for k in range(part.num_rows):
                row = {c: part[c][k].as_py() for c in part.schema.names} | {"shards": shards}
                yield row, _Tokens(row)

    def ask_pairs(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, tokens in token_rows(parts):
            before, word, taught, _, _ = tokens.pairs()
            context, number, seen = tokens.number[before], tokens.number[word], tokens.count[before]
            yield ask_rows(row["block"], _pair_shards(context, number, seen, total, shards),
                             [context, number, taught, seen.astype(np.uint64)], _in_runs)[0]

    def pair_codes(told: list[list[np.ndarray]], shard: int) -> list[list[np.ndarray]]:
        told = [_from_runs(t) for t in told]
        context, word, taught, seen = (np.concatenate([t[k] for t in told]).astype(np.uint64) for k in range(4))
        taught_at = np.flatnonzero(taught)
        order = taught_at[np.lexsort((word[taught_at], context[taught_at]))]
        c, w = context[order], word[order]
        first = np.flatnonzero(np.concatenate([[True], (c[1:] != c[:-1]) | (w[1:] != w[:-1])])) if len(c) else np.empty(0, np.int64)
        times = np.add.reduceat(taught[order], first) if len(first) else np.empty(0, np.uint64)
        often = seen[order][first]
        with tempfile.TemporaryFile() as file:  # gone when the task lets go of it
            file.write(build_trie(c[first], w[first], quantised(times / np.maximum(often, 1))))
            file.flush()
            codes = Trie(np.memmap(file, np.uint8, "r")).look_up(context, word)
        answers = [[x] for x in np.split(codes, np.cumsum([len(t[0]) for t in told])[:-1])]
        singular = np.bincount(_class(often)[times == 1], minlength=CLASSES)
        answers[0].append(np.concatenate([singular, np.bincount(_class(often), times, CLASSES)]).astype(np.uint64))
        return answers

    def scores(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, tokens in token_rows(parts):
            before, word, _, at, which = tokens.pairs()
            seen = tokens.count[before]
            order = np.argsort(_pair_shards(tokens.number[before], tokens.number[word], seen, total, shards), kind="stable")
            share = probabilities(in_order(row["codes_of_pairs"], order, 1)[0].astype(np.int64))
            count = tokens.count[tokens.token]
            base = np.log10((count + 0.5) / (total + 0.5 * (distinct + 1)))
            new = discount * distinct / total if total else 1.0
            single = np.where(count > 0, (count - discount) / max(total, 1), new)
            times = tokens.count[tokens.before]
            weight = np.where(times > 0, backoff[_class(times)], 1.0)
            found = np.zeros(len(count))
            found[at] = share[which]
            model = np.log10((1 - weight) * found + weight * single)
            n = len(tokens.sizes)
            sums = [np.bincount(tokens.document, x, n) for x in (count > 0, base, model)]
            yield pa.RecordBatch.from_arrays([
                pa.array(row["doc_ids"], pa.int64()), pa.array(np.frombuffer(row["learn"], bool)),
                pa.array(tokens.sizes + 1), pa.array(sums[0].astype(np.int64)), pa.array(np.full(n, total, np.int64)),
                pa.array(sums[1]), pa.array(sums[2])],
                ["doc_id", "learn", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    with_known = blocks.drop("n_words", "words").join(gathered(known, "known"), "block")
    pairs = materialize(answered(with_known.mapInArrow(tidy(ask_pairs), ASK_DDL), pair_codes), "pair-codes")
    figures = np.array(_summary(pairs, 1, 2 * CLASSES), float)
    backoff = np.minimum((figures[:CLASSES] + 1) / (figures[CLASSES:] + 1), MOST_BACKOFF)
    return with_known.join(gathered(pairs, "codes_of_pairs"), "block", "left").mapInArrow(
        tidy(scores), "doc_id long, learn boolean, n_tokens long, n_known long, train_tokens long, "
                "base_score double, score double")
