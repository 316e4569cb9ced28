"""Documents in blocks of a few megabytes, and questions that blocks put to shards.

An operator that needs corpus-wide figures for many small things in each document asks once per block for
each distinct thing. Questions go to a shard by hash as packed arrays; the shard, which sees all that blocks
ask and tell about its things, answers each block in the order of its questions. So a thing that stands in a
third of all documents costs one entry per block, not one per document.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.memory import tidy
from fleetlens.llm.text import picked
from fleetlens.session import materialize

#: Bytes of text after which a block ends; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20
#: Bytes of text per shard, and shards at least.
SHARD_BYTES, LEAST_SHARDS = 16 << 20, 48

ASK = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("data", pa.binary())])
ANSWER = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("data", pa.binary())])
ASK_DDL, ANSWER_DDL = "shard int, block long, data binary", "block long, shard int, data binary"


def write_blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """block, doc_ids, texts, bytes: the rows of ``docs`` in blocks, written once to the shared folder.

    Written, because all later steps must see the same blocks, also after the loss of an executor.
    """
    schema = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                        ("texts", pa.list_(pa.string())), ("bytes", pa.int64())])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"block": block, "doc_ids": ids, "texts": texts, "bytes": size}], schema)

        for part in parts:
            for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True):
                ids.append(doc_id)
                texts.append(text)
                size += 4 * len(text) if text and not text.isascii() else len(text or "")
                if size >= BLOCK_BYTES:
                    yield row()
                    block, ids, texts, size = block + 1, [], [], 0
        if ids:
            yield row()

    packed = picked(docs, id_col, text_col).mapInArrow(
        tidy(batches), "block long, doc_ids array<long>, texts array<string>, bytes long")
    return materialize(packed, "blocks")


def shard_count(blocks: DataFrame) -> int:
    """Shards for these blocks: their number follows the size of the text."""
    total = blocks.agg(F.sum("bytes")).first()[0] or 0
    return max(LEAST_SHARDS, -(-total // SHARD_BYTES))


def packed(arrays: list[np.ndarray]) -> bytes:
    """Arrays as bytes. Whole numbers that are small take fewer of them, stored plane by plane and compressed if it helps."""
    out = []
    for x in arrays:
        if x.dtype.kind == "u" and x.itemsize > 1:
            x = x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))
        data = x.tobytes()
        if x.dtype.kind == "u" and x.itemsize < 8 and len(x) > 64:
            small = zlib.compress(x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes(), 1)
            data = small if len(small) < 0.9 * len(data) else data
        out.append(np.array([ord(x.dtype.kind), x.itemsize, len(x), len(data)], np.int64).tobytes() + data)
    return b"".join(out)


def unpacked(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        kind, size, n, stored = np.frombuffer(data, np.int64, 4, at).tolist()
        at += 32
        if stored == n * size:
            out.append(np.frombuffer(data, f"{chr(kind)}{size}", n, at))
        else:
            planes = np.frombuffer(zlib.decompress(data[at:at + stored]), np.uint8).reshape(size, n)
            out.append(np.ascontiguousarray(planes.T).view(f"{chr(kind)}{size}").ravel())
        at += stored
    return out


def spread(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each key (uint64)."""
    mixed = (keys ^ (keys >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(shards)).astype(np.int32)


def ask_rows(block: int, shard: np.ndarray, arrays: list[np.ndarray],
             form: Callable[[list[np.ndarray]], list[np.ndarray]] = list) -> tuple[pa.RecordBatch, np.ndarray]:
    """A row per shard with the block's questions to it in some form, and the order in which they were put."""
    order = np.argsort(shard, kind="stable")
    shard = shard[order]
    first = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if len(shard) else np.empty(0, np.int64)
    ends = np.append(first, len(shard))[1:]
    arrays = [x[order] for x in arrays]
    data = [packed(form([x[a:b] for x in arrays])) for a, b in zip(first, ends, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(shard[first], pa.int32()), pa.array([block] * len(first), pa.int64()),
                                       pa.array(data, pa.binary())], schema=ASK), order


def answered(asks: DataFrame, answer: Callable[[list[list[np.ndarray]], int], list[list[np.ndarray]]]) -> DataFrame:
    """block, shard, data: ``answer`` gets what every block has asked a shard, and answers each."""
    def of_shard(table: pa.Table) -> pa.Table:
        if not table.num_rows:
            return ANSWER.empty_table()
        told = [unpacked(x) for x in table["data"].to_pylist()]
        data = [packed(x) for x in answer(told, table["shard"][0].as_py())]
        return pa.table([table["block"], table["shard"], pa.array(data, pa.binary())], schema=ANSWER)

    return asks.groupBy("shard").applyInArrow(of_shard, ANSWER_DDL)


def gathered(answers: DataFrame, name: str = "answers") -> DataFrame:
    """The answers of each block in one row; they are as many as the block's own questions."""
    return answers.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("shard", "data"))).alias(name))


def in_order(rows: list[dict] | None, order: np.ndarray, n_arrays: int) -> list[np.ndarray]:
    """The answers of a block, put back into the order of its questions."""
    parts = [unpacked(x["data"]) for x in rows or []]
    out = []
    for k in range(n_arrays):
        flat = np.concatenate([p[k] for p in parts]) if parts else np.empty(0, np.uint64)
        back = np.empty(len(flat), flat.dtype)
        back[order] = flat
        out.append(back)
    return out


def word_hashes(texts: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all words of the texts in turn, words per text, and the 64-bit hash of each code.

    Words are runs of other than ASCII white space; ``lower`` lower-cases A-Z first. Null has none.
    """
    texts = pc.ascii_trim_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    n_words = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    blank = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    flat = parts.flatten()
    if blank.any():
        flat = flat.filter(pc.not_equal(pc.binary_length(flat), 0))
        n_words[blank] = 0
    words = flat.dictionary_encode()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
    return words.indices.to_numpy(zero_copy_only=False).astype(np.int64), n_words, hashes
