"""SimHash near-duplicates by meeting in the middle between fingerprints.

Two fingerprints that differ in 3 bits differ in at least one bit of one of four 16-bit groups, and then in at
most two of the other 48 bits. With that group masked out, both reach a common variant by flipping at most one
bit each: half the radius that is left (or they differ within the group alone, and meet as they are). So
every distinct fingerprint emits 4 x 49 variants; those that meet in a variant are compared. A variant has at
most 49 x 65,536 fingerprints, whatever the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.components import components
from fleetlens.llm.memory import tidy
from fleetlens.llm.text import picked
from fleetlens.session import materialize

BITS, GROUP_BITS = 64, 16
SHINGLE, DISTANCE, SEED = 3, 3, 42
#: Shingles whose bits are counted at a time, which bounds the memory of a very long text.
SLICE = 1 << 16


def _fingerprints(texts: pa.Array, shingle: int) -> np.ndarray:
    """The fingerprint of each text as uint64; null and wordless texts have zero."""
    texts = pc.ascii_lower(pc.fill_null(texts, ""))
    parts = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    n_words = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    n_words[pc.equal(pc.binary_length(pc.ascii_trim_whitespace(texts)), 0).to_numpy(zero_copy_only=False)] = 0
    out = np.zeros(len(texts), np.uint64)
    shift = np.arange(BITS, dtype=np.uint64)
    for row in np.flatnonzero(n_words):
        words = parts[int(row)].values
        size = min(shingle, int(n_words[row]))
        joined = " ".join(words.to_pylist()).encode()
        ends = np.cumsum(pc.binary_length(words).to_numpy().astype(np.int64) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        first, last = starts[:len(starts) - size + 1], ends[size - 1:]
        counts = np.zeros(BITS, np.int64)
        for at in range(0, len(first), SLICE):
            hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(
                first[at:at + SLICE].tolist(), last[at:at + SLICE].tolist(), strict=True)), np.uint64)
            bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
        out[row] = np.bitwise_or.reduce((counts * 2 > len(first)).astype(np.uint64) << shift)
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE, keyed: bool = False) -> DataFrame:
    """doc_id, print (the 64-bit fingerprint as a signed long) for each row; ``keyed`` adds text_key, a hash of the text.

    Words are runs of other than white space after lower-casing A-Z. Fewer words than a shingle are one
    shingle; null, empty and blank texts have fingerprint zero.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            prints = _fingerprints(part["text"].cast(pa.large_string()), shingle).view(np.int64)
            more = ["text_key"] * keyed
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(prints), *map(part.column, more)], ["doc_id", "print", *more])

    plain = picked(docs, id_col, text_col)
    if keyed:
        plain = plain.withColumn("text_key", F.xxhash64("text"))
    return plain.mapInArrow(tidy(batches), "doc_id long, print long" + ", text_key long" * keyed)


def signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _one_flip(prints: DataFrame) -> DataFrame:
    """mask (0), variant, print: each print with at most one of its bits flipped."""
    flips = F.array(*[F.lit(signed(f)) for f in (0, *(1 << bit for bit in range(BITS)))])
    return prints.select(F.lit(0).cast("byte").alias("mask"), F.explode(F.transform(
        flips, lambda f: F.col("print").bitwiseXOR(f))).alias("variant"), "print")


def _variants(prints: DataFrame) -> DataFrame:
    """mask, variant, print: each print with one group masked out and at most one of the other bits flipped."""
    def masked_out(mask: int) -> Column:
        masked = ((1 << GROUP_BITS) - 1) << (mask * GROUP_BITS)
        flips = [0, *(1 << bit for bit in range(BITS) if not masked >> bit & 1)]
        kept = F.col("print").bitwiseAND(F.lit(signed(((1 << BITS) - 1) ^ masked)))
        return F.transform(F.array(*[F.lit(signed(f)) for f in flips]), lambda f: F.struct(
            F.lit(mask).cast("byte").alias("mask"), kept.bitwiseXOR(f).alias("variant")))

    rows = [masked_out(mask) for mask in range(BITS // GROUP_BITS)]
    return prints.select("print", F.explode(F.concat(*rows)).alias("v")).select("v.mask", "v.variant", "print")


#: Ways to change none, one or two bits of a group's value.
ONE_OFF = np.concatenate([[0], 1 << np.arange(GROUP_BITS)]).astype(np.uint64)
TWO_OFF = np.array([1 << a | 1 << b for a in range(GROUP_BITS) for b in range(a)], np.uint64)


def _star(meeting: np.ndarray, value: np.ndarray, member: np.ndarray, near: np.ndarray,
          far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within each meeting and group value at which members stand after the changes ``near`` and ``far``.

    The least of those that came by a near change is linked with all others there; a place without such has none.
    """
    flips = np.concatenate([near, far])
    place = (meeting.astype(np.uint64)[:, None] << np.uint64(GROUP_BITS)) | (value[:, None] ^ flips)
    place, off = place.ravel(), np.tile(np.arange(len(flips)) >= len(near), len(member))
    member = np.repeat(member, len(flips))
    order = np.lexsort((member, off, place))
    place, off, member = place[order], off[order], member[order]
    lead = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    n = np.diff(np.concatenate([lead, [len(place)]]))
    centre = np.repeat(member[lead], n)
    linked = ~np.repeat(off[lead], n) & (member != centre)
    return centre[linked], member[linked]


def _balls(mask: np.ndarray, variant: np.ndarray, prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links at distance 1 or 2 among the prints that are one flip at most from each variant; rows come sorted by it.

    Two such prints differ in two bits at most, so at distance 2 all link with the least of them; at distance 1
    they link with the print that is the variant itself, if it is there.
    """
    start = np.flatnonzero(np.concatenate([[True], variant[1:] != variant[:-1]]))
    size = np.diff(np.append(start, len(variant)))
    if distance == 2:
        centre, linked = np.repeat(np.minimum.reduceat(prints, start), size), True
    else:
        centre, linked = variant, np.repeat(np.logical_or.reduceat(prints == variant, start), size)
    at = linked & (prints != centre)
    pairs = np.unique(np.sort(np.stack([prints[at], centre[at]], axis=1), axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def _stars(mask: np.ndarray, variant: np.ndarray, prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among the prints that meet in each variant; rows come sorted by mask and variant.

    Two meeting prints differ in two kept bits at most; they link if their masked groups are near too. A pair is
    compared directly. In a larger meeting, members that are one masked bit apart both stand at a value that one
    of them has; those with the same kept bits, which may be three masked bits apart, both stand at a value one
    bit off the one and two off the other. All at a value link with the least of them, so a meeting costs a
    fixed number of rows per member, however large it is.
    """
    new = np.concatenate([[True], (mask[1:] != mask[:-1]) | (variant[1:] != variant[:-1])])
    start = np.flatnonzero(new)
    size = np.diff(np.concatenate([start, [len(prints)]]))
    two = start[size == 2]
    found = [(prints[two], prints[two + 1])]
    crowd = np.repeat(size > 2, size)
    if crowd.any():
        meeting, member = np.repeat(np.arange(len(start)), size)[crowd], prints[crowd]
        own, bits = mask[crowd].astype(np.uint64) * np.uint64(GROUP_BITS), member.view(np.uint64)
        value = (bits >> own) & np.uint64((1 << GROUP_BITS) - 1)
        found.append(_star(meeting, value, member, ONE_OFF[:1], ONE_OFF[1:]))
        same = (bits ^ (value << own)) == variant[crowd].view(np.uint64)
        same &= np.bincount(meeting, same, len(start))[meeting] > 1
        if same.any():
            found.append(_star(meeting[same], value[same], member[same], ONE_OFF, TWO_OFF))
    a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    near = np.bitwise_count((a ^ b).view(np.uint64)) <= distance
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1)[near], axis=0)
    return pairs[:, 0], pairs[:, 1]


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """a, b: links between distinct fingerprints (column ``print``) that differ in at most ``distance`` bits.

    Any two such fingerprints are connected by these links, directly or through others. ``distance`` is 3 at
    most. Distances of 1 and 2 need no masks: two such prints meet in a print one flip at most from both.
    """
    if not 0 <= distance <= DISTANCE:
        raise ValueError(f"distance must be 0 to {DISTANCE}")
    found = _stars if distance == DISTANCE else _balls
    if distance == 0:
        return prints.limit(0).select(F.col("print").alias("a"), F.col("print").alias("b"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.empty(0, np.int8), np.empty(0, np.int64), np.empty(0, np.int64)]
        for part in _then_end(parts):
            if part is None:
                done, rest = rest, None
            else:
                rows = [np.concatenate([x, part[i].to_numpy()]) for i, x in enumerate(rest)]
                last = np.flatnonzero((rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1]))
                cut = int(last[-1]) + 1 if len(last) else 0  # the last meeting may go on in the next batch
                done, rest = [x[:cut] for x in rows], [x[cut:] for x in rows]
            if len(done[0]):
                a, b = found(*done, distance)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    met = (_variants if distance == DISTANCE else _one_flip)(prints.select("print")).repartition("mask", "variant").sortWithinPartitions("mask", "variant")
    return met.mapInArrow(tidy(batches), "a long, b long").distinct()


def _then_end(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from (part for part in parts if part.num_rows)
    yield None


def _rooted(printed: DataFrame, least: Column, distance: int) -> DataFrame:
    """print, least (of its rows), root (one print of its component) for each distinct print."""
    classes = materialize(printed.groupBy("print").agg(least.alias("least")), "fingerprint-classes")
    roots = components(links(classes, distance))
    return classes.join(roots, classes["print"] == roots["node"], "left") \
        .select("print", "least", F.coalesce("root", "print").alias("root"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (least doc_id reachable over links) for each row.

    Equal fingerprints link, fingerprint zero too. Rows with a null id come back; they connect others but do
    not name a component, which is null if it has no other id. Repeated rows come back as often as they are
    there. Other columns are ignored.
    """
    printed = materialize(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    rooted = _rooted(printed, F.min("doc_id"), distance)
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = rooted.join(named, "root").select("print", "component_id")
    return printed.join(of_print, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             distance: int = DISTANCE) -> DataFrame:
    """Of each group the row with the least id, with all its columns.

    Rows are told apart by id and a 64-bit hash of the text: of rows that share the least id of their group the
    one with the least hash stays, and one of those that repeat id and text. A null id ranks above every other.
    """
    printed = materialize(fingerprints(docs, id_col, text_col, shingle, keyed=True), "fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    kept = _rooted(printed, F.min(row), distance).groupBy("root").agg(F.min("least").alias("least")) \
        .select(F.col("least.doc_id").alias("__id"), F.col("least.text_key").alias("__key"))
    keyed = docs.withColumns({"__row": F.col(id_col).cast("long"), "__text": F.xxhash64(F.col(text_col).cast("string"))})
    return keyed.join(kept, F.col("__row").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__key")), "left_semi") \
        .dropDuplicates(["__row", "__text"]).drop("__row", "__text")
