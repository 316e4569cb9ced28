"""MinHash near-duplicates by an inverted join of signature coordinates.

A document is the set of its distinct shingles; rows with equal sets are one class. A class has one least hash
for each of 64 coordinates. Two sets of similarity 0.8 share 51 of the 64 coordinate values on average, and
fewer than 32 in 2 of 10^8 cases, so pairs with at least 32 collisions are held against each other in full.

Collisions are not counted for all pairs. Values that one class alone has are dropped, and with them every class
that is left with fewer than 32. The others are ordered from rare to frequent; two classes with 32 collisions
meet in one of the first ``c - 31`` of their ``c`` shared values, so only this prefix is posted, and the long lists of
frequent values are skipped. Where a list meets, all collisions of a pair are counted on one byte per coordinate,
and two bitmaps of 2,048 bits bound what the sets can share.

A list of near copies costs a few rows per member, however long it is: members are compared with a leader first, and
what is linked becomes one component. Then the members that are not of a list's largest component meet all members
of other components; a long list is cut into blocks for that, and each pair of blocks is a unit of work of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.blocks import word_hashes
from fleetlens.llm.components import components
from fleetlens.llm.memory import tidy
from fleetlens.llm.text import picked
from fleetlens.session import materialize

SHINGLE, PERCENT = 5, 80
COORDINATES, COLLISIONS, BITS = 64, 32, 2048
#: Rounds in which the members of a list meet one leader each, before those of different components meet.
LEADER_ROUNDS = 2
#: Members of a list that are a block; pairs that are compared at a time.
LIST_BLOCK, PAIRS_AT_A_TIME = 2048, 1 << 15
#: Bytes of text and rows hashed at a time; a longer text is taken alone. Hashes taken at a time for least values.
SLICE_BYTES, SLICE_ROWS, AT_A_TIME = 4 << 20, 2048, 1 << 16


def _cuts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with little enough text, or one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(ends):
        most = (ends[start - 1] if start else 0) + SLICE_BYTES
        stop = max(start + 1, min(start + SLICE_ROWS, int(np.searchsorted(ends, most, side="right"))))
        yield start, stop
        start = stop


def _sets(texts: pa.Array, shingle: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text; null and wordless texts have none."""
    codes, n_words, hashes = word_hashes(texts, lower=True)
    words = hashes[codes]
    last = np.cumsum(n_words)
    first = last - n_words
    rolled, partial = words.copy(), {}
    for k in range(1, shingle + 1):
        partial[k] = rolled  # of k words, read by texts that have no more
        if k < shingle:
            rolled = (rolled ^ (rolled >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            rolled[:len(words) - k] += words[k:]
    out = []
    for a, n in zip(first.tolist(), n_words.tolist(), strict=True):
        size = min(shingle, n)
        found = np.sort(partial[size][a:a + n - size + 1]) if n else words[:0]
        out.append(found[np.concatenate([[True], found[1:] != found[:-1]])] if n else found)
    return out


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The least hash per coordinate of each set, which must not be empty; the low bits name the coordinate."""
    flat = np.concatenate(sets)
    ends = np.cumsum([len(s) for s in sets])
    mixers = np.random.default_rng(11).integers(0, 1 << 64, (2, COORDINATES), np.uint64)
    out = np.empty((len(sets), COORDINATES), np.uint64)
    row = 0
    while row < len(sets):
        start = int(ends[row]) - len(sets[row])
        stop = max(row + 1, int(np.searchsorted(ends, start + AT_A_TIME, side="right")))
        some, starts = flat[start:ends[stop - 1]], np.concatenate([[0], ends[row:stop - 1] - start])
        for k in range(COORDINATES):
            mixed = (some ^ mixers[0, k]) * (mixers[1, k] | np.uint64(1))
            mixed ^= mixed >> np.uint64(32)
            out[row:stop, k] = np.minimum.reduceat(mixed * np.uint64(0x9E3779B97F4A7C15), starts)
        row = stop
    return (out & ~np.uint64(COORDINATES - 1)) | np.arange(COORDINATES, dtype=np.uint64)


def _features(sets: list[np.ndarray], values: np.ndarray) -> np.ndarray:
    """A byte of each coordinate value, a bitmap of the hashes, and how many of its bits are set, as longs per set."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    bit = (np.concatenate(sets) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BITS.bit_length() + 1)
    marks = np.zeros((len(sets), BITS), bool)
    marks[row, bit.astype(np.int64)] = True
    byte = (values >> np.uint64(24)).astype(np.uint8).view(np.int64)
    return np.hstack([byte, np.packbits(marks, axis=1).view(np.int64), marks.sum(axis=1, keepdims=True)])


def signed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n (size of the set), key (two longs that name the set), text_key, values, features for each row.

    ``values`` are the coordinate values; they, the key and the features are null for an empty set.
    """
    longs = pa.list_(pa.int64())
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("key", longs), ("text_key", longs),
                        ("values", longs), ("features", longs)])

    def rows(part: pa.RecordBatch) -> pa.RecordBatch:
        sets = _sets(part["text"], shingle)
        some = [k for k, s in enumerate(sets) if len(s)]
        values, features, key = [None] * len(sets), [None] * len(sets), [None] * len(sets)
        if some:
            found = _signatures([sets[k] for k in some])
            more = _features([sets[k] for k in some], found)
            for row, k in enumerate(some):
                digest = xxhash.xxh3_128_digest(sets[k].tobytes())
                values[k], features[k], key[k] = found[row].view(np.int64), more[row], np.frombuffer(digest, np.int64)
        return pa.RecordBatch.from_arrays([
            part["doc_id"], pa.array([len(s) for s in sets], pa.int64()), pa.array(key, longs), part["text_key"],
            pa.array(values, longs), pa.array(features, longs)], schema=schema)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for start, stop in _cuts(part["text"]):
                yield rows(part.slice(start, stop - start))

    plain = picked(docs, id_col, text_col).withColumn("text_key", _text_key("text"))
    return plain.mapInArrow(tidy(batches), "doc_id long, n long, key array<long>, text_key array<long>, "
                                           "values array<long>, features array<long>")


def _text_key(text: str) -> Column:
    return F.array(F.xxhash64(text), F.xxhash64(F.lit(1), text))


def shingle_sets(docs: DataFrame, text_col: str, wanted: DataFrame, shingle: int) -> DataFrame:
    """key, shingles of the texts whose ``text_key`` is in ``wanted``; one row per text."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for start, stop in _cuts(part["text"]):
                sets = _sets(part["text"].slice(start, stop - start), shingle)
                keys = [np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64) for s in sets]
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys, longs), pa.array([s.view(np.int64) for s in sets], longs)], ["key", "shingles"])

    texts = docs.select(F.col(text_col).cast("string").alias("text")).withColumn("text_key", _text_key("text"))
    once = texts.join(wanted, "text_key", "left_semi").dropDuplicates(["text_key"])
    return once.select("text").mapInArrow(tidy(batches), "key array<long>, shingles array<long>")


#: Places in the features: longs of the sketch, longs of the bitmap, and the number of its bits.
SKETCH, BITMAP, N_BITS = range(COORDINATES // 8), range(COORDINATES // 8, (COORDINATES + BITS // 8) // 8), (COORDINATES + BITS // 8) // 8


def _may_link(x: str, y: str, percent: int) -> Column:
    """Whether two classes have enough collisions, and can share enough shingles.

    Bits that one of them alone has stand for shingles that it alone has.
    """
    def of(side: str, k: int) -> Column:
        return F.get(f"{side}.features", F.lit(k))

    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    either = sum((F.bit_count(of(x, k).bitwiseOR(of(y, k))).cast("long") for k in BITMAP), F.lit(0))
    differ = F.lit(0)
    for k in SKETCH:
        d = of(x, k).bitwiseXOR(of(y, k))
        for bits, mask in ((4, 0x0F0F0F0F0F0F0F0F), (2, 0x0303030303030303), (1, 0x0101010101010101)):
            d = d.bitwiseOR(F.shiftrightunsigned(d, bits)).bitwiseAND(F.lit(mask))
        differ = differ + F.bit_count(d)
    shared = F.least(n + of(y, N_BITS), m + of(x, N_BITS)) - either
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * shared >= percent * (n + m)) \
        & (differ <= COORDINATES - COLLISIONS)


def _pairs(n: np.ndarray, features: np.ndarray, root: np.ndarray, minor: np.ndarray, block: np.ndarray,
           crossed: bool, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs that may link, as ``_may_link`` says, each of a minor member and one of another component.

    ``crossed``: of different blocks only.
    """
    words = np.ascontiguousarray(features.T)
    found_x, found_y = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    xs = np.flatnonzero(minor)
    step = max(1, PAIRS_AT_A_TIME // max(1, len(n)))
    for at in range(0, len(xs), step):
        x = xs[at:at + step]
        maybe = (root[x, None] != root) & (~minor | (x[:, None] < np.arange(len(n))))
        if crossed:
            maybe &= block[x, None] != block
        maybe &= 100 * np.minimum(n[x, None], n) >= percent * np.maximum(n[x, None], n)
        either = np.zeros(maybe.shape, np.int64)
        for k in BITMAP:
            either += np.bitwise_count((words[k, x, None] | words[k]).view(np.uint64))
        shared = np.minimum(n[x, None] + words[N_BITS], n + words[N_BITS, x, None]) - either
        maybe &= (100 + percent) * shared >= percent * (n[x, None] + n)
        i, y = np.nonzero(maybe)
        i = x[i]
        same = (features[i, :len(SKETCH)].view(np.uint8) == features[y, :len(SKETCH)].view(np.uint8)).sum(axis=1)
        found_x.append(i[same >= COLLISIONS])
        found_y.append(y[same >= COLLISIONS])
    return np.concatenate(found_x), np.concatenate(found_y)


def postings(classes: DataFrame) -> DataFrame:
    """value, id, c, n, features: each class under the coordinate values of its prefix, where another class has them too.

    ``c`` is how many of its values other classes have.
    """
    values = classes.select("id", F.explode("values").alias("value"))
    shared = values.groupBy("value").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    ordered = values.join(shared, "value").groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("often", "value"))).alias("v"))
    prefix = ordered.filter(F.size("v") >= COLLISIONS).select(
        "id", F.size("v").alias("c"), F.explode(F.slice("v", F.lit(1), F.size("v") - (COLLISIONS - 1))).alias("v"))
    return prefix.join(classes.select("id", "n", "features"), "id").select("v.value", "id", "c", "n", "features")


def _with_leader(posted: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs of each member of a list with the list's leader of this turn, if they are of different components.

    The first leader is the member that shares most values, the next ones are drawn.
    """
    rank = F.xxhash64(F.lit(turn), "id") if turn else -F.col("c")
    leaders = posted.groupBy("value").agg(F.min(F.struct(rank.alias("rank"), "id", "n", "features", "root")).alias("x"))
    return posted.alias("y").join(leaders, "value").filter(
        (F.col("x.root") != F.col("y.root")) & _may_link("x", "y", percent)).select(
        F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))


def _within_lists(posted: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of a list that are of different components; each has one outside the list's largest component."""
    sizes = posted.groupBy("value", "root").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.groupBy("value").agg(F.max(F.struct("size", "root")).alias("m"),
                                         F.ceil(F.sum("size") / LIST_BLOCK).alias("blocks"))
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    cells = posted.join(largest, "value").select(
        "value", "id", "n", "features", "root", (F.col("root") != F.col("m.root")).alias("minor"),
        F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block"), F.explode(other).alias("other"))
    cell = ["value", "low", "high"]
    dealt = cells.select("value", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                         "id", "n", "features", "root", "minor", "block") \
        .repartition(*cell).sortWithinPartitions(*cell)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(parts, 3):
            ids, n, root, block, low, high = (rows[c].to_numpy() for c in ("id", "n", "root", "block", "low", "high"))
            minor = rows["minor"].to_numpy(zero_copy_only=False)
            features = rows["features"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
            value = rows["value"].to_numpy()
            new = np.flatnonzero((value[1:] != value[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])) + 1
            for a, b in zip([0, *new.tolist()], [*new.tolist(), len(ids)], strict=True):
                if minor[a:b].any() and b - a > 1:
                    x, y = _pairs(n[a:b], features[a:b], root[a:b], minor[a:b], block[a:b], low[a] != high[a], percent)
                    x, y = ids[a:b][x], ids[a:b][y]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])

    return dealt.mapInArrow(tidy(batches), "a long, b long")


def whole_groups(parts: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The rows of sorted batches, cut so that no group of the first ``keys`` columns is split."""
    kept: list[pa.RecordBatch] = []
    for part in parts:
        if not part.num_rows:
            continue
        last = np.ones(part.num_rows, bool)
        for k in range(keys):
            column = part.column(k).to_numpy()
            last &= column == column[-1]
        start = part.num_rows - int(np.argmin(last[::-1])) if not last.all() else 0
        same = kept and all(kept[-1].column(k)[-1] == part.column(k)[0] for k in range(keys))
        if kept and (start or not same):
            yield pa.Table.from_batches([*kept, part.slice(0, start)]) if start else pa.Table.from_batches(kept)
            kept = []
        elif start:
            yield pa.Table.from_batches([part.slice(0, start)])
        kept.append(part.slice(start))
    if kept:
        yield pa.Table.from_batches(kept)


def _mixed(posted: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The postings with ``root``, the component of each class, without lists of one component alone."""
    if roots is None:
        rooted = posted.withColumn("root", F.col("id"))
    else:
        rooted = posted.join(roots, posted["id"] == roots["node"], "left").select(
            posted["*"], F.coalesce("root", "id").alias("root"))
    mixed = rooted.groupBy("value").agg(F.min("root").alias("r"), F.max("root").alias("s")).filter("r <> s")
    return rooted.join(mixed.select("value"), "value", "left_semi")


def links(classes: DataFrame, docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE,
          percent: int = PERCENT) -> DataFrame | None:
    """node, root: components of the classes over all pairs whose full sets are similar enough; None if there is none."""
    posted = materialize(postings(classes), "minhash-postings")
    sets = found = roots = None

    def with_sets(nodes: DataFrame) -> DataFrame:
        """``sets`` and those of ``nodes`` that it lacks."""
        lacking = nodes if sets is None else nodes.join(sets, "id", "left_anti")
        asked = classes.join(lacking, "id", "left_semi").select("id", "key", "text_key")
        read = shingle_sets(docs, text_col, asked.select("text_key"), shingle).join(asked, "key").select("id", "shingles")
        more = materialize(read.dropDuplicates(["id"]), "minhash-sets")
        return more if sets is None else sets.unionByName(more)

    for turn in range(LEADER_ROUNDS + 1):
        mixed = materialize(_mixed(posted, roots), "minhash-lists")
        pairs = _with_leader(mixed, turn, percent) if turn < LEADER_ROUNDS else _within_lists(mixed, percent)
        pairs = materialize(pairs.distinct(), "minhash-pairs")
        sets = with_sets(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
        linked = materialize(_confirmed(pairs, sets, percent), "minhash-links")
        found = linked if found is None else found.unionByName(linked)
        if not linked.isEmpty():
            roots = components(found)
    return roots


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b of which 100 * intersection >= percent * union, on the full sets."""
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("s")), "a") \
        .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("t")), "b") \
        .withColumn("common", F.size(F.array_intersect("s", "t")))
    union = F.size("s") + F.size("t") - F.col("common")
    return both.filter(100 * F.col("common") >= percent * union).select("a", "b")


def minhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                   percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable over links), kept for each row.

    Words are runs of other than ASCII white space after lower-casing A-Z. Fewer words than a shingle are one
    shingle; null, empty and blank texts have an empty set and link with nothing, so each is its own
    component. ``kept`` says that the row names its component. A null id names a component only if it has no
    other id; such rows are then all kept. Repeated rows come back as often as they are there and are kept alike.
    An empty table gives none. Texts of any length are taken whole: the text and 8 bytes for each of its words
    must fit a task. Other columns are ignored. Shingles are told apart by 64 bits of hash, sets by 128.
    """
    rows = materialize(signed(docs, id_col, text_col, shingle), "minhash-signed")
    one = F.first(F.struct("n", "text_key", "values", "features")).alias("one")
    classes = rows.filter("n > 0").groupBy("key").agg(F.min("doc_id").alias("least"), one).select(
        F.monotonically_increasing_id().alias("id"), "key", "least", "one.*")
    classes = materialize(classes, "minhash-classes")
    roots = links(classes, docs, text_col, shingle, percent)
    named = classes.select("id", "key", "least")
    if roots is None:
        named = named.withColumnRenamed("least", "component_id")
    else:
        rooted = named.join(roots, named["id"] == roots["node"], "left").select(
            "key", "least", F.coalesce("root", "id").alias("root"))
        least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
        named = rooted.join(least, "root")
    full = rows.filter("n > 0").join(named.select("key", "component_id"), "key").select("doc_id", "n", "component_id")
    empty = rows.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return full.unionByName(empty).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
