"""How far the sources of a language differ in their terms: segment trees over term ids that share equal subtrees.

Counts are summed per language, source and term first; what follows never sees a document. The terms of a language
are numbered, and each run of 4,096 numbers is a subtree that a task builds for all sources at once, leaves first:
a leaf is a count, a node a pair of nodes of the level below, and equal ones are one node (most are the node of
zeros). A pair of sources is priced by going down both trees at once. Of all places of a level at which the
same two nodes meet, one goes on and carries their number; at the leaves each distinct pair of counts is priced once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.memory import tidy
from fleetlens.session import materialize

#: Documents of its language that a term must stand in, count added to each term, and the scale of shares.
LEAST_DOCS, ADDED, SCALE = 30, 5, 1_000_000_000
#: Ranks of the terms of a group that are reported.
TOP_TERMS = 50
#: Term ids per block (a power of two), and pairs of sources that go down a block's trees at a time.
TERMS_PER_BLOCK, PAIRS_AT_A_TIME = 4096, 512
#: Bytes of text and rows counted at a time.
SLICE_BYTES, SLICE_ROWS = 4 << 20, 4096


def _term_bytes() -> np.ndarray:
    """Each byte of UTF-8 as it counts in a term: letters in lower case, bytes of other characters as they are, else a space."""
    table = np.arange(256, dtype=np.uint8)
    letters = np.arange(ord("A"), ord("Z") + 1)
    table[:128] = ord(" ")
    table[letters + 32] = table[letters] = letters + 32
    return table


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row and code of each term of the texts, and the distinct terms by code."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    clean = pa.Array.from_buffers(pa.large_string(), len(texts), [
        None, pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(_term_bytes()[data].tobytes())])
    parts = pc.ascii_split_whitespace(clean)
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    flat = parts.flatten()
    some = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    words = flat.filter(pa.array(some)).dictionary_encode()
    return row[some], words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary


def _counted(part: pa.RecordBatch) -> pa.RecordBatch:
    """lang, source, term, n, docs of the rows of a batch; each group also has a row without a term."""
    group = pa.StructArray.from_arrays([part["lang"], part["source"]], ["lang", "source"])
    keys = pc.binary_join_element_wise(
        pc.utf8_length(part["lang"]).cast(pa.string()), part["lang"], part["source"], ":").dictionary_encode()
    groups = keys.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    _, example = np.unique(groups, return_index=True)
    row, code, terms = _terms(part["text"])
    in_doc, n = np.unique(row * max(1, len(terms)) + code, return_counts=True)
    row, code = np.divmod(in_doc, max(1, len(terms)))
    found, where = np.unique(groups[row] * max(1, len(terms)) + code, return_inverse=True)
    of_group, code = np.divmod(found, max(1, len(terms)))
    total = np.zeros(len(found), np.int64)
    np.add.at(total, where, n)
    docs = np.bincount(where, minlength=len(found)).astype(np.int64)
    named = group.take(pa.array(np.concatenate([example[of_group], example])))
    none = len(example)
    return pa.RecordBatch.from_arrays([
        named.field("lang"), named.field("source"),
        pa.concat_arrays([terms.take(pa.array(code)).cast(pa.string()), pa.nulls(none, pa.string())]),
        pa.array(np.concatenate([total, np.zeros(none, np.int64)])),
        pa.array(np.concatenate([docs, np.zeros(none, np.int64)]))], ["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that have it), and a row with a null term for each group.

    Terms are runs of letters A-Z and of characters beyond ASCII, with A-Z in lower case. Null counts as empty in
    all three columns.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ends = np.cumsum(pc.binary_length(part["text"]).to_numpy(zero_copy_only=False).astype(np.int64))
            start = 0
            while start < len(ends):
                most = (ends[start - 1] if start else 0) + SLICE_BYTES
                stop = max(start + 1, min(start + SLICE_ROWS, int(np.searchsorted(ends, most, side="right"))))
                yield _counted(part.slice(start, stop - start))
                start = stop

    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in (
        (lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    counted = plain.mapInArrow(tidy(batches), "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def numbered(terms: DataFrame) -> DataFrame:
    """The rows (lang, term) with ``term_id``, dense from 0 within each language, without all of them in one task.

    Ids follow the order of the terms: ranges of it are numbered in tasks of their own, after the sizes of the
    ranges before, of which there are as many as tasks.
    """
    dealt = terms.select("lang", "term").repartitionByRange("lang", "term").withColumn("part", F.spark_partition_id())
    dealt = materialize(dealt, "divergence-terms")
    sizes = dealt.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("size"))
    before = F.coalesce(F.sum("size").over(Window.partitionBy("lang").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("lang", "part", before.alias("start"))
    place = F.row_number().over(Window.partitionBy("lang", "part").orderBy("term")) - 1
    return dealt.withColumn("place", place).join(starts, ["lang", "part"]).select(
        "lang", "term", (F.col("start") + F.col("place")).alias("term_id"))


def _shares(counts: np.ndarray, total: int, n_terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + ADDED) / (total + ADDED * n_terms)), exact, by long division in three steps."""
    below = total + ADDED * n_terms
    rest = counts.astype(object if below > 1 << 52 else np.int64) + ADDED
    out, rest = rest // below, rest % below
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // below, rest % below
    return (out + 1).astype(np.int64)


def _trees(counts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Trees over the rows of ``counts``, of which equal subtrees are one node.

    Returns the distinct counts (the leaves), the two children of each node level by level, and each row's root.
    """
    leaves, nodes = np.unique(counts, return_inverse=True)
    nodes, levels = nodes.reshape(counts.shape), []
    while nodes.shape[1] > 1:
        wide = int(nodes.max(initial=0)) + 1
        children, at = np.unique(nodes[:, ::2] * wide + nodes[:, 1::2], return_inverse=True)
        levels.append(np.stack(np.divmod(children, wide), axis=1))
        nodes = at.reshape(len(counts), -1)
    return leaves, levels, nodes[:, 0]


def _distances(counts: np.ndarray, totals: list[int], n_terms: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The sum of the differences of shares over the columns, a power of two of them, for each pair of rows x, y."""
    leaves, levels, roots = _trees(counts)
    shares = np.stack([_shares(leaves, t, n_terms) for t in totals])
    out = np.zeros(len(x), np.int64)
    for at in range(0, len(x), PAIRS_AT_A_TIME):
        a, b = x[at:at + PAIRS_AT_A_TIME], y[at:at + PAIRS_AT_A_TIME]
        pair, left, right, times = np.arange(len(a)), roots[a], roots[b], np.ones(len(a), np.int64)
        for children in reversed(levels):
            pair = np.concatenate([pair, pair])
            left, right = children[left].T.ravel(), children[right].T.ravel()
            times = np.concatenate([times, times])
            order = np.lexsort((right, left, pair))
            pair, left, right, times = pair[order], left[order], right[order], times[order]
            new = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (left[1:] != left[:-1]) | (right[1:] != right[:-1])]))
            pair, left, right, times = pair[new], left[new], right[new], np.add.reduceat(times, new)
        price = np.abs(shares[a[pair], left] - shares[b[pair], right]) * times
        np.add.at(out[at:at + PAIRS_AT_A_TIME], pair, price)
    return out


def _powers(n: int) -> Iterator[tuple[int, int]]:
    """Ranges whose lengths are powers of two and cover n places, longest first."""
    start = 0
    while start < n:
        size = 1 << ((n - start).bit_length() - 1)
        yield start, start + size
        start += size


def _block(rows: pa.Table, top: int) -> pa.Table:
    """Partial results of one block of term ids of a language.

    Rows with a null ``term_id`` name the groups, with their totals; the others are counts.
    """
    head = rows.filter(pc.is_null(rows["term_id"])).sort_by("source")
    body = rows.filter(pc.is_valid(rows["term_id"]))
    lang, sources = head["lang"][0].as_py(), head["source"].to_pylist()
    totals, n_terms, block = head["total"].to_pylist(), head["n_terms"][0].as_py(), head["block"][0].as_py()
    width = min(TERMS_PER_BLOCK, n_terms - block * TERMS_PER_BLOCK)
    counts = np.zeros((len(sources), width), np.int64)
    place = body["term_id"].to_numpy() - block * TERMS_PER_BLOCK
    row = pc.index_in(body["source"], head["source"].combine_chunks()).to_numpy()
    counts[row, place] = body["n"].to_numpy()
    terms = np.empty(width, object)
    terms[place] = body["term"].to_pylist()

    x, y = np.triu_indices(len(sources), 1)
    value = np.zeros(len(x), np.int64)
    for a, b in _powers(width):
        value += _distances(counts[:, a:b], totals, n_terms, x, y)
    out = {"source": [], "part": [], "item": [], "value": []}
    for i, j in ((x, y), (y, x)):
        out["source"] += [sources[k] for k in i]
        out["item"] += [sources[k] for k in j]
        out["value"] += value.tolist()
    out["part"] = ["pair"] * len(out["source"])

    of_lang = _shares(counts.sum(axis=0), sum(totals), n_terms)
    for k, source in enumerate(sources):
        more = _shares(counts[k], totals[k], n_terms) - of_lang
        better = np.flatnonzero((counts[k] > 0) & (more > 0))
        if len(better) > top:  # no term below the value of the last place can be among the first
            better = better[more[better] >= np.partition(more[better], -top)[-top]]
        ranked = sorted(better.tolist(), key=lambda t: (-more[t], terms[t]))[:top]
        out["source"] += [source] * len(ranked)
        out["part"] += ["term"] * len(ranked)
        out["item"] += [terms[t] for t in ranked]
        out["value"] += [int(more[t]) for t in ranked]
    return pa.table({"lang": pa.array([lang] * len(out["source"]), pa.string()), **{
        name: pa.array(values, pa.int64() if name == "value" else pa.string()) for name, values in out.items()}})


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank for each group (lang, source).

    A language keeps the terms that at least ``least_docs`` of its documents have. The share of a kept term is
    1 + floor(10^9 (count + 5) / (N + 5 V)), in whole numbers: N sums the counts of the group, V is the number of kept
    terms. Part ``pair`` has a row for each other source of the language, with the sum over all kept terms
    of the differences of shares; part ``term`` the ``top`` terms that the group has and uses more than its language does.
    Ranks go by value, largest first, then by item in the order of UTF-8 bytes.

    Null language, source and text count as empty; a group without kept terms, even one without texts, has its
    pairs. Repeated rows count each time, ids are not read, an empty table gives no rows. A text is taken whole by
    one task, which holds it and its terms. Other columns are ignored. The result has a row for each pair of
    sources of a language, as many as are asked for.
    """
    def of_block(rows: pa.Table) -> pa.Table:
        return _block(rows, top)

    counts = materialize(term_counts(docs, text_col, lang_col, source_col), "divergence-counts")
    groups = counts.filter("term IS NULL").select("lang", "source")
    kept = materialize(counts.filter("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("docs").alias("docs"))
                       .filter(F.col("docs") >= least_docs), "divergence-kept")
    ids = materialize(numbered(kept), "divergence-ids")
    body = materialize(counts.join(ids, ["lang", "term"]).select("lang", "source", "term", "term_id", "n"), "divergence-body")
    totals = body.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = ids.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"))
    known = materialize(groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("n_terms", F.lit(0)).alias("n_terms")),
        "divergence-groups")
    last = F.floor((F.col("n_terms") - 1) / TERMS_PER_BLOCK)
    none = F.lit(None)
    heads = known.filter("n_terms > 0").select(
        "lang", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"), "source", "total", "n_terms",
        none.cast("string").alias("term"), none.cast("long").alias("term_id"), none.cast("long").alias("n"))
    rows = body.select(
        "lang", F.floor(F.col("term_id") / TERMS_PER_BLOCK).alias("block"), "source", none.cast("long").alias("total"),
        none.cast("long").alias("n_terms"), "term", "term_id", "n")
    parts = materialize(heads.unionByName(rows).groupBy("lang", "block").applyInArrow(
        of_block, "lang string, source string, part string, item string, value long"), "divergence-parts")
    x, y = known.filter("n_terms = 0").alias("x"), known.alias("y")
    nothing = x.join(y, (F.col("x.lang") == F.col("y.lang")) & (F.col("x.source") != F.col("y.source"))).select(
        "x.lang", "x.source", F.lit("pair").alias("part"), F.col("y.source").alias("item"), F.lit(0).cast("long").alias("value"))
    summed = parts.unionByName(nothing).groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    return _ranked(summed.filter("part = 'pair'"), None).unionByName(_ranked(summed.filter("part = 'term'"), top))


def _ranked(rows: DataFrame, top: int | None) -> DataFrame:
    order: list[Column] = [F.col("value").desc(), F.col("item").asc()]
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))
    return ranked if top is None else ranked.filter(F.col("rank") <= top)
