"""Spelling variants of frequent words, found through neighbourhoods over a reduced alphabet.

Letters are hashed to a few symbols. One edit of a word is one edit of its reduced form, or none, so every word
within one edit has its reduced form in the full one-edit neighbourhood of the other's. Distinct reduced forms
generate their neighbourhoods, which are joined with the reduced vocabulary, and the words behind both sides
are held against each other. With 4 symbols a form of 10 letters has about 75 neighbours, with 60 letters some 1,200.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.memory import tidy
from fleetlens.llm.text import picked
from fleetlens.session import materialize

#: Code points and occurrences a word has at least, and how many times as frequent its form is.
LEAST_LENGTH, LEAST_TIMES, FORM_TIMES = 5, 3, 2
#: Symbols of the reduced alphabet, base of the hash of reduced words, neighbours written at a time.
SYMBOLS, BASE, NEIGHBOURS_AT_A_TIME = 4, 0x9E3779B97F4A7C15, 1 << 18
#: Bytes of text and rows counted at a time; words of more bytes get their checksums one by one.
SLICE_BYTES, SLICE_ROWS, LONG_RUN = 4 << 20, 4096, 64


def _runs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row and code of each run of letters A-Z and U+00C0 to U+00FF, and the distinct runs, A-Z in lower case."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    lower = np.where((data >= ord("A")) & (data <= ord("Z")), data + 32, data).astype(np.uint8)
    latin = data == 0xC3  # first byte of U+00C0 to U+00FF in UTF-8
    kept = (lower >= ord("a")) & (lower <= ord("z")) | latin
    kept[1:] |= latin[:-1]
    clean = pa.Array.from_buffers(pa.large_string(), len(texts), [
        None, pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(np.where(kept, lower, ord(" ")).astype(np.uint8).tobytes())])
    parts = pc.ascii_split_whitespace(clean)
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    flat = parts.flatten()
    some = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    words = flat.filter(pa.array(some)).dictionary_encode()
    return row[some], words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary


def _checksums(starts: np.ndarray, runs: list[bytes], row: np.ndarray, code: np.ndarray,
               tables: dict[int, np.ndarray]) -> np.ndarray:
    """crc32 of (a text whose crc32 is ``starts[row]``, followed by ``runs[code]``) for each row and code.

    The checksum of a text put before another one is a linear function of the first one's checksum and the
    length of the second one, which is kept in ``tables``, exclusive-or the checksum of the second one.
    """
    sizes = np.array([len(r) for r in runs], np.int64)
    out = np.array([zlib.crc32(r) for r in runs], np.uint32)[code]
    size = sizes[code]
    for n in np.unique(sizes).tolist():
        at = np.flatnonzero(size == n)
        before = starts[row[at]]
        if n > LONG_RUN:
            out[at] = [zlib.crc32(runs[c], b) for c, b in zip(code[at].tolist(), before.tolist(), strict=True)]
            continue
        if n not in tables:
            zeros = bytes(n)
            none = zlib.crc32(zeros)
            tables[n] = np.array([[zlib.crc32(zeros, v << 8 * k) ^ none for v in range(256)] for k in range(4)], np.uint32)
        for k in range(4):
            out[at] ^= tables[n][k][(before >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def _counted(part: pa.RecordBatch, misprints: int | None, least: int, tables: dict[int, np.ndarray]) -> pa.RecordBatch:
    row, code, runs = _runs(part["text"])
    times = np.bincount(code, minlength=len(runs)).astype(np.int64)
    changed: dict[str, int] = {}
    if misprints and len(runs):
        ids = part["doc_id"].to_pylist()
        starts = np.array([0 if i is None else zlib.crc32(b"%d:" % i) for i in ids], np.uint32)
        pairs, n = np.unique(row * len(runs) + code, return_counts=True)
        row, code = np.divmod(pairs, len(runs))
        named = np.array([i is not None for i in ids])[row]
        row, code, n = row[named], code[named], n[named]
        words = runs.to_pylist()
        h = _checksums(starts, [w.encode() for w in words], row, code, tables)
        for at in np.flatnonzero(h % misprints == 0).tolist():
            word, k = words[code[at]], int(h[at]) % len(words[code[at]])
            short = word[:k] + word[k + 1:]
            changed[short] = changed.get(short, 0) + int(n[at])
            times[code[at]] -= n[at]
    word = pa.concat_arrays([runs.cast(pa.string()), pa.array(list(changed), pa.string())])
    counted = pa.RecordBatch.from_arrays([word, pa.array(np.concatenate([times, list(changed.values())]).astype(np.int64))], ["word", "n"])
    return counted.filter(pc.and_(pc.greater_equal(pc.utf8_length(word), least), pc.greater(counted["n"], 0)))


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", misprints: int | None = None,
               least_length: int = LEAST_LENGTH, least_times: int = LEAST_TIMES) -> DataFrame:
    """word, n: runs of letters (A-Z and U+00C0 to U+00FF, A-Z in lower case) that are long and frequent enough.

    ``misprints`` drops a letter of some of them first, to have variants to look for: with h the crc32 of
    ``<doc_id>:<run>``, the code point h % length of a run whose h it divides. Rows without an id keep theirs.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[int, np.ndarray] = {}
        for part in parts:
            ends = np.cumsum(pc.fill_null(pc.binary_length(part["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            start = 0
            while start < len(ends):
                most = (ends[start - 1] if start else 0) + SLICE_BYTES
                stop = max(start + 1, min(start + SLICE_ROWS, int(np.searchsorted(ends, most, side="right"))))
                yield _counted(part.slice(start, stop - start), misprints, least_length, tables)
                start = stop

    counted = picked(docs, id_col, text_col).mapInArrow(tidy(batches), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_times)


def _reduced(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of words of one length, and their symbols (1 to ``SYMBOLS``) as a matrix, length by length."""
    sizes = np.array([len(w) for w in words], np.int64)
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        points = np.frombuffer("".join(words[k] for k in at.tolist()).encode("utf-32-le"), np.uint32).reshape(len(at), size)
        mixed = points.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        yield at, (mixed >> np.uint64(40)) % np.uint64(SYMBOLS) + np.uint64(1)


def _powers(n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = np.multiply.accumulate(np.full(n - 1, BASE, np.uint64)) if n > 1 else out[1:]
    return out


def _hashes(symbols: np.ndarray) -> np.ndarray:
    """A hash of each row of symbols; ``_neighbours`` has those of edited rows without building them."""
    return (symbols * _powers(symbols.shape[1])).sum(axis=1, dtype=np.uint64)


def _neighbours(symbols: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and hashes of all distinct forms within one edit of each row, itself included."""
    rows, size = symbols.shape
    power = _powers(size + 2)
    zero = np.zeros((rows, 1), np.uint64)
    here = symbols * power[:size]
    before = np.hstack([zero, np.cumsum(here, axis=1, dtype=np.uint64)])
    whole = before[:, -1:]

    def moved(terms: np.ndarray) -> np.ndarray:
        """Sums of the terms from each place on, and nothing beyond the last."""
        total = np.cumsum(terms, axis=1, dtype=np.uint64)
        return np.hstack([total[:, -1:], total[:, -1:] - total])

    left = moved(np.hstack([zero, symbols[:, 1:] * power[:size - 1]]))  # letters moved one place to the left
    right = moved(symbols * power[1:size + 1])
    number = np.arange(rows)
    found = [(number, whole[:, 0])]
    new = np.hstack([np.ones((rows, 1), bool), symbols[:, 1:] != symbols[:, :-1]])  # of equal letters the first goes
    gone = before[:, :-1] + left[:, 1:]
    found.append((np.broadcast_to(number[:, None], gone.shape)[new], gone[new]))
    for c in range(1, SYMBOLS + 1):
        symbol = np.uint64(c)
        other = symbols != symbol
        replaced = whole - here + symbol * power[:size]
        found.append((np.broadcast_to(number[:, None], replaced.shape)[other], replaced[other]))
        first = np.hstack([np.ones((rows, 1), bool), other])  # not after an equal letter, before which it does as well
        added = before + symbol * power[:size + 1] + right
        found.append((np.broadcast_to(number[:, None], added.shape)[first], added[first]))
    return found


def near_words(words: DataFrame) -> DataFrame:
    """word, n, near, near_n for all pairs of words (columns word, n) that one inserted, deleted or replaced code point parts."""
    def forms(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = np.empty(part.num_rows, np.uint64)
            for at, symbols in _reduced(part["word"].to_pylist()):
                out[at] = _hashes(symbols)
            yield pa.RecordBatch.from_arrays([part["word"], part["n"], pa.array(out.view(np.int64))], ["word", "n", "form"])

    def around(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            own = part["form"].to_numpy()
            for at, symbols in _reduced(part["word"].to_pylist()):
                step = max(1, NEIGHBOURS_AT_A_TIME // (2 * SYMBOLS * (symbols.shape[1] + 1)))
                for k in range(0, len(at), step):
                    for row, found in _neighbours(symbols[k:k + step]):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(own[at[k:k + step]][row]), pa.array(found.view(np.int64))], ["form", "near_form"])

    reduced = materialize(words.mapInArrow(tidy(forms), "word string, n long, form long"), "spelling-forms")
    each = reduced.groupBy("form").agg(F.min("word").alias("word"))
    neighbours = each.mapInArrow(tidy(around), "form long, near_form long")
    met = neighbours.join(reduced.select(F.col("form").alias("near_form")).distinct(), "near_form")
    mine = met.join(reduced, "form").select("word", "n", "near_form")
    others = reduced.select(F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("form").alias("near_form"))
    return mine.join(others, (mine["near_form"] == others["near_form"]) & (F.levenshtein("word", "near", 1) == 1)) \
        .select("word", "n", "near", "near_n")


def _roots(forms: DataFrame) -> DataFrame:
    """word, root for the words of ``forms`` (columns word, form): the last word when forms are followed.

    Each round doubles how far every word has come. A form is at least twice as frequent as its word, so chains are
    short and have no circles.
    """
    now = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        then = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        on = now.join(then, "root", "left")
        if on.filter("next IS NOT NULL").isEmpty():
            return now
        now = materialize(on.select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", misprints: int | None = None,
             least_length: int = LEAST_LENGTH, least_times: int = LEAST_TIMES, form_times: int = FORM_TIMES) -> DataFrame:
    """word, form, root, n, n_near, form_n for each word of ``vocabulary``.

    Near words differ by one inserted, deleted or replaced code point. The form of a word is its most frequent near
    word (the least in code-point order among several), if that is at least ``form_times`` (2 or more) as frequent, else null;
    root follows forms to the last one. Null and empty texts have no words, an empty table gives no rows; repeated
    rows count each time. A text is counted whole in one task, which holds it and its words; a word has
    about 8 neighbours for each of its letters. Other columns are ignored.
    """
    if form_times < 2:
        raise ValueError("forms of forms end only if each is at least twice as frequent")
    words = materialize(vocabulary(docs, id_col, text_col, misprints, least_length, least_times), "spelling-words")
    near = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    known = materialize(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.minus") >= form_times * F.col("n"), F.struct(
            F.col("best.near").alias("form"), (-F.col("best.minus")).alias("n"))).alias("to")), "spelling-near")
    roots = _roots(known.filter("to IS NOT NULL").select("word", "to.form"))
    return known.join(roots, "word", "left").select(
        "word", F.col("to.form").alias("form"), F.coalesce("root", "word").alias("root"), "n", "n_near",
        F.col("to.n").alias("form_n"))
