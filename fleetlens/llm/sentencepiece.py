"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

Text is normalised as the model asks (a marker in front, markers for spaces) and cut where no piece can reach
across. Distinct cuts are encoded together: all of them walk the trie in step, so the work per character is a
few array operations and not Python code. Characters without a piece are spelt in byte pieces.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.memory import tidy

#: Fixed values of the model format: the marker of a space, kinds of pieces, and the score below the least
#: piece that an unknown character gets.
MARKER = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_PENALTY = 10.0
#: Cells (cuts x bytes) that are encoded together, which bounds the memory of a task.
CELLS = 1 << 20


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value, shift, at = value | (byte & 127) << shift, shift + 7, at + 1
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        if key & 7 == 0:
            value, at = _varint(data, at)
        else:
            size, at = _varint(data, at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = data[at:at + size], at + size
        yield key >> 3, value


def double_array(pieces: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base, check and the number that ends at each state (or -1).

    The child of a state by a byte is ``base[state] + byte`` if ``check`` there is the state.
    """
    children: list[dict[int, int]] = [{}]
    ends = [-1]
    for piece, number in pieces.items():
        node = 0
        for byte in piece:
            if byte not in children[node]:
                children[node][byte] = len(children)
                children.append({})
                ends.append(-1)
            node = children[node][byte]
        ends[node] = number
    size = 4 * len(children) + 1024
    taken = bytearray(size)
    base, check, end = [-1] * size, [-1] * size, [-1] * size
    place = [0] * len(children)
    taken[0], free, start = 1, 1, 1
    for node, below in enumerate(children):  # parents come before their children
        end[place[node]] = ends[node]
        if not below:
            continue
        keys = sorted(below)
        free = taken.index(0, free)
        at = max(free, keys[0] + 1) if len(keys) == 1 else max(start, keys[0] + 1)
        first, tried = at, 1
        while True:
            at = taken.index(0, at)
            if not any(taken[at - keys[0] + k] for k in keys):
                break
            at, tried = at + 1, tried + 1
            if at + 512 > len(taken):
                taken.extend(bytes(size))
                for x in (base, check, end):
                    x.extend([-1] * size)
        if len(keys) > 1 and tried > 64:
            start = first + (at - first) // 2  # what lies before is nearly full
        base[place[node]] = at - keys[0]
        for k in keys:
            taken[at - keys[0] + k] = 1
            check[at - keys[0] + k] = place[node]
            place[below[k]] = at - keys[0] + k
    return tuple(np.array(x, np.int32) for x in (base, check, end))


class Memory:
    """Ids of the cuts met so far, one after the other."""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.starts, self.sizes, self.ids = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)

    def add(self, cuts: list[str], ids: list[np.ndarray]) -> None:
        self.rows.update(zip(cuts, range(len(self.rows), len(self.rows) + len(cuts)), strict=True))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, *ids])


class Model:
    """Pieces, scores and normalisation of a SentencePiece model file."""

    def __init__(self, data: bytes):
        self.pieces, scores, kinds = [], [], []
        self.dummy_prefix, self.remove_extra, self.escape, self.byte_fallback, normaliser = True, True, True, False, b""
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece.get(1, b""))
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                self.byte_fallback = bool(dict(_fields(value)).get(35, 0))
            elif number == 3:
                spec = dict(_fields(value))
                normaliser = spec.get(2, b"")
                self.dummy_prefix, self.remove_extra, self.escape = (bool(spec.get(k, 1)) for k in (3, 4, 5))
        if normaliser:
            raise ValueError("models with character maps are not supported")
        self.scores, self.kinds = np.array(scores, np.float64), np.array(kinds)
        self.unknown = kinds.index(UNKNOWN)
        usable = {p: n for n, p in enumerate(self.pieces) if p and kinds[n] in (NORMAL, USER_DEFINED)}
        known = [scores[n] for n in usable.values()]
        self.unknown_score = min(known, default=0.0) - UNKNOWN_PENALTY
        # A piece that the model's owner has defined is always taken whole.
        best = max(known, default=0.0)
        for n in usable.values():
            if kinds[n] == USER_DEFINED:
                self.scores[n] = len(self.pieces[n]) * best - 0.1
        self.base, self.check, self.end = double_array(usable)
        self.byte_ids = np.full(256, self.unknown, np.int32)
        for n, piece in enumerate(self.pieces):
            if kinds[n] == BYTE:
                self.byte_ids[int(piece[3:5], 16)] = n
        text = [p.decode() for p in usable]
        # Text may be cut before a marker that follows something else, and around characters of no piece.
        self.cuts = not any(MARKER in p.lstrip(MARKER) for p in text)
        alone = "" if any("\n" in p for p in text) else "\n"
        self.cut = re.compile(f"{alone}|{MARKER}*[^{MARKER}{alone}]+|{MARKER}+" if alone else
                              f"{MARKER}*[^{MARKER}]+|{MARKER}+")
        self.spelling = [
            b"" if kind == CONTROL else bytes([int(p[3:5], 16)]) if kind == BYTE else
            b" \xe2\x81\x87 " if kind == UNKNOWN else p for p, kind in zip(self.pieces, kinds, strict=True)]

    def step(self, states: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The next state of each, or -1."""
        base = self.base[states]
        to = np.minimum(base + byte, len(self.check) - 1)
        return np.where((base >= 0) & (self.check[to] == states), to, -1)

    def normalise(self, text: str) -> str:
        if self.remove_extra:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        if self.dummy_prefix:
            text = " " + text
        return text.replace(" ", MARKER) if self.escape else text

    def _together(self, cuts: list[bytes]) -> list[np.ndarray]:
        """Ids of each cut; all cuts advance byte by byte in step."""
        n, width = len(cuts), max(map(len, cuts))
        text = np.zeros((n, width + 1), np.int32)
        size = np.fromiter(map(len, cuts), np.int64, n)
        text[np.arange(width + 1) < size[:, None]] = np.frombuffer(b"".join(cuts), np.uint8)
        is_start = (text & 0xC0) != 0x80  # of a character
        best = np.full((n, width + 1), -np.inf)
        best[:, 0] = 0
        from_at, from_id = np.zeros((n, width + 1), np.int32), np.full((n, width + 1), -1, np.int32)

        def offer(row: np.ndarray, to: np.ndarray, score: np.ndarray, at: int, number: np.ndarray | int) -> None:
            better = score > best[row, to]
            row, to = row[better], to[better]
            best[row, to], from_at[row, to] = score[better], at
            from_id[row, to] = number[better] if isinstance(number, np.ndarray) else number

        length = np.where(text < 0x80, 1, np.where(text < 0xE0, 2, np.where(text < 0xF0, 3, 4)))
        for at in range(width):
            alive = np.flatnonzero((size > at) & is_start[:, at])
            if not len(alive):
                continue
            char = at + length[alive, at]
            whole = np.zeros(n, bool)
            row, state = alive, np.zeros(len(alive), np.int32)
            for to in range(at, width):
                state = self.step(state, text[row, to])
                on = (state >= 0) & (to < size[row])
                row, state = row[on], state[on]
                if not len(row):
                    break
                number = self.end[state]
                found = number >= 0
                if found.any():
                    hit, number = row[found], number[found]
                    whole[hit[to + 1 == at + length[hit, at]]] = True
                    offer(hit, np.full(len(hit), to + 1), best[hit, at] + self.scores[number], at, number)
            bare = ~whole[alive]
            if bare.any():
                offer(alive[bare], char[bare], best[alive[bare], at] + self.unknown_score, at, self.unknown)
        # Back from the ends, again in step; the last piece of each cut comes first.
        steps, place = [], size.copy()
        row = np.flatnonzero(place > 0)
        while len(row):
            number, start = np.full(n, -1, np.int32), np.zeros(n, np.int64)
            number[row], start[row] = from_id[row, place[row]], from_at[row, place[row]]
            steps.append((number, start))
            place[row] = start[row]
            row = row[place[row] > 0]
        ids = np.stack([number for number, _ in steps[::-1]], axis=1)
        spelt = (ids == self.unknown).any(axis=1) if self.byte_fallback else np.zeros(n, bool)
        out = np.split(ids[ids >= 0], np.cumsum((ids >= 0).sum(axis=1))[:-1])
        starts = np.stack([start for _, start in steps[::-1]], axis=1)
        for k in np.flatnonzero(spelt).tolist():
            at = starts[k][ids[k] >= 0].tolist() + [int(size[k])]
            out[k] = np.concatenate([self.byte_ids[text[k, a:b]] if number == self.unknown else np.array([number], np.int32)
                                     for number, a, b in zip(out[k].tolist(), at[:-1], at[1:], strict=True)])
        return out

    def encode_cuts(self, cuts: list[str]) -> list[np.ndarray]:
        """Ids of each of the cuts, which are encoded together with others of like length."""
        raw = [c.encode() for c in cuts]
        order = sorted(range(len(raw)), key=lambda k: len(raw[k]))
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(raw)
        first = 0
        while first < len(order):
            shortest, last = len(raw[order[first]]), first + 1
            while last < len(order) and (last - first + 1) * (len(raw[order[last]]) + 1) <= CELLS and (
                    len(raw[order[last]]) <= shortest + shortest // 4 + 2):
                last += 1
            for k, ids in zip(order[first:last], self._together([raw[k] for k in order[first:last]]), strict=True):
                out[k] = ids
            first = last
        return out

    def encode(self, texts: list[str | None], memory: Memory | None = None) -> list[np.ndarray]:
        """Ids of each text; ``memory`` carries the ids of cuts from call to call."""
        memory = Memory() if memory is None else memory
        parts = []
        for text in texts:
            text = self.normalise(text or "")
            parts.append(self.cut.findall(text) if self.cuts else [text] * bool(text))
        new = list({c: None for part in parts for c in part if c not in memory.rows})
        memory.add(new, self.encode_cuts(new))
        rows = np.fromiter((memory.rows[c] for part in parts for c in part), np.int64)
        sizes = memory.sizes[rows]
        ends = np.cumsum(sizes)
        within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)
        ids = memory.ids[np.repeat(memory.starts[rows], sizes) + within]
        bounds = np.concatenate([[0], ends])[np.cumsum([len(part) for part in parts])]
        return np.split(ids, bounds[:-1])

    def decode(self, ids: np.ndarray) -> str:
        """The text that ids spell. Control pieces are silent; bytes that are no UTF-8 become U+FFFD."""
        spelt = [self.spelling[i] for i in ids.tolist()]
        text = b"".join(spelt).decode("utf-8", "replace")
        text = text.replace(MARKER, " ") if self.escape else text
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


#: Cuts a task remembers before it starts anew.
MEMORY = 250_000


def load(path: str) -> Model:
    """The model of a file on the driver."""
    with open(path, "rb") as file:
        return Model(file.read())


def _shared(model: Model, spark: SparkSession) -> Broadcast:
    """Pieces and trie (a few megabytes), built once and sent to every task as plain arrays."""
    return spark.sparkContext.broadcast(vars(model))


def _received(shared: Broadcast) -> Model:
    model = Model.__new__(Model)
    vars(model).update(shared.value)
    return model


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
           with_text: bool = False) -> DataFrame:
    """doc_id, ids (array of int), n_tokens, n_bytes (tokens that are byte pieces), round_trip, per row.

    ``round_trip``: decoding the ids gives the text back, which fails only where the normalisation itself loses
    something (a marker character in the text, or spaces if the model removes extra ones). Null and empty texts
    have no ids. Rows, also repeated ones and those with a null id, come back one for one; other columns are
    ignored. ``with_text`` adds ``decoded``. Only models without a precompiled character map are supported; most
    published unigram models have one (nmt_nfkc), and are refused with an error.
    """
    shared = _shared(load(model_path), docs.sparkSession)
    names = ["doc_id", "ids", "n_tokens", "n_bytes", "round_trip"] + ["decoded"] * with_text
    types = [pa.int64(), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.bool_(), pa.string()]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _received(shared)
        is_byte = model.kinds == BYTE
        memory = Memory()
        for part in parts:
            for first in range(0, part.num_rows, 512):
                piece = part.slice(first, 512)
                texts = piece["text"].to_pylist()
                rows = []
                for doc_id, text, ids in zip(piece["doc_id"].to_pylist(), texts, model.encode(texts, memory), strict=True):
                    decoded = model.decode(ids)
                    rows.append([doc_id, ids, len(ids), int(is_byte[ids].sum()), decoded == (text or ""), decoded][:len(names)])
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names)
                if len(memory.rows) > MEMORY:
                    memory = Memory()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(tidy(batches), "doc_id long, ids array<int>, n_tokens long, n_bytes long, round_trip boolean"
                    + ", decoded string" * with_text)


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text: the text that ``ids`` spell; a null list gives null, ids that are no piece fail."""
    shared = _shared(load(model_path), encoded.sparkSession)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _received(shared)
        for part in parts:
            texts = [None if ids is None else model.decode(np.array(ids, np.int64)) for ids in part["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids")) \
        .mapInArrow(tidy(batches), "doc_id long, text string")
