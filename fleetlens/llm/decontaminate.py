"""Benchmark decontamination by winnowing, with SQL functions only.

Every window of words has a fingerprint: the least hash of the word groups inside it. Equal windows have
equal fingerprints, so a document needs a closer look only where it shares one with a benchmark window.
Hits are extended to all windows around the shared group and compared with the benchmark's words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.text import let, lower_ascii, picked
from fleetlens.session import materialize

#: Words of a window, and of the groups that are hashed inside it.
WINDOW, GROUP = 13, 5
#: A side of a join is broadcast only if its written rows have been measured and stay under this size.
BROADCAST_BYTES = 32 << 20


def words(text: Column) -> Column:
    """Runs of digits, a-z and characters beyond ASCII, after lower-casing A-Z; null has none."""
    return F.array_remove(F.split(lower_ascii(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _spans(n: Column, length: int) -> Column:
    """Starts (from 0) of all spans of ``length`` among ``n`` words."""
    return F.when(n >= length, F.sequence(F.lit(0), n - length)).otherwise(F.array().cast("array<int>"))


def _groups(hashes: Column, window: int) -> Column:
    """Hash of each group of words, for windows of this length."""
    size = min(GROUP, window)
    return let(hashes, lambda h: F.transform(
        _spans(F.size(h), size), lambda i: F.xxhash64(F.lit(window), F.slice(h, i + 1, F.lit(size)))))


def _fingerprints(groups: Column, window: int) -> Column:
    """The least group hash of each window, distinct."""
    width = window - min(GROUP, window) + 1
    if width == 1:
        return F.array_distinct(groups)
    return let(groups, lambda g: F.array_distinct(F.transform(
        _spans(F.size(g), width), lambda i: F.array_min(F.slice(g, i + 1, F.lit(width))))))


def _word_hashes(column: str) -> Column:
    return F.transform(column, lambda w: F.xxhash64(w))


def _windows(parts: Column, starts: Column, length: int) -> Column:
    """The windows of this length at ``starts``, with their words."""
    return let(parts, lambda w: F.transform(starts, lambda s: F.struct(
        s.alias("start"), F.lit(length).alias("length"),
        F.array_join(F.slice(w, s + 1, F.lit(length)), " ").alias("window"))))


def _small(table: DataFrame, row_bytes: Column | int) -> DataFrame:
    """``table`` (written before) marked for broadcast if it is small; else Catalyst joins by shuffles."""
    total = table.agg(F.sum(F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes)).first()[0]
    return F.broadcast(table) if (total or 0) <= BROADCAST_BYTES else table


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """length, window (its words, joined by a space), item_id, print. Items of fewer words are one window."""
    items = benchmark.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("words")) \
        .filter(F.size("words") > 0) \
        .select("item_id", "words", F.least(F.size("words"), F.lit(WINDOW)).alias("length"))
    starts = F.sequence(F.lit(0), F.size("words") - F.col("length"))
    cut = items.select("item_id", "length", "words", F.explode(starts).alias("start")) \
        .select("item_id", "length", F.expr("slice(words, start + 1, length)").alias("part")).distinct()
    hashed = cut.withColumn("hashes", _word_hashes("part"))
    least = F.lit(None).cast("long")
    for n in range(1, WINDOW + 1):
        least = F.when(F.col("length") == n, F.array_min(_groups(F.col("hashes"), n))).otherwise(least)
    return hashed.select("length", F.array_join("part", " ").alias("window"), "item_id", least.alias("print"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, text_key.

    A document word inside any occurrence of a benchmark window is hit; a document is contaminated if at least
    a twentieth of its words are. Null and empty texts have no words and are clean. Rows are told apart by id
    and text, so null and repeated ids do no harm, and repeated rows come back as often as they are there.
    Items without words, or an empty benchmark, match nothing; a null item id is skipped in the item list.
    Other columns are ignored.
    """
    windows = materialize(benchmark_windows(benchmark, item_col, item_text_col), "benchmark-windows")
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect())  # 1..WINDOW at most
    plain = picked(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))

    split = plain.select("doc_id", "text_key", words(F.col("text")).alias("words"))
    hashed = split.select("doc_id", "text_key", F.size("words").cast("long").alias("n_words"),
                          _word_hashes("words").alias("hashes"))
    prints = [_fingerprints(_groups(F.col("hashes"), n), n) for n in lengths]
    printed = materialize(hashed.select("doc_id", "text_key", "n_words", F.concat(
        *prints, F.array().cast("array<bigint>")).alias("prints")), "document-prints")

    # Fingerprints of a document that a benchmark window has too.
    asked = _small(windows.select(F.col("print")).distinct(), 32)
    shared = materialize(
        printed.select("doc_id", "text_key", F.explode("prints").alias("print")).join(asked, "print", "left_semi")
        .groupBy("doc_id", "text_key").agg(F.collect_set("print").alias("shared")), "shared-prints")

    # All windows around the shared groups, compared with the benchmark's by their words.
    near = _small(shared.withColumnsRenamed({"doc_id": "near_id", "text_key": "near_key"}), 64 + 8 * F.size("shared"))
    close = plain.join(
        near, F.col("doc_id").eqNullSafe(F.col("near_id")) & (F.col("text_key") == F.col("near_key"))) \
        .dropDuplicates(["doc_id", "text_key"]) \
        .select("doc_id", "text_key", "shared", words(F.col("text")).alias("words")) \
        .withColumn("hashes", _word_hashes("words"))
    candidates = []
    for n in lengths:
        reach = n - min(GROUP, n)  # a window that holds the group at p starts in p - reach .. p
        at = F.transform(_groups(F.col("hashes"), n), lambda g, i: F.when(F.array_contains("shared", g), i))
        at = F.filter(at, lambda i: i.isNotNull())
        starts = F.flatten(F.transform(at, lambda i: F.sequence(
            F.greatest(i - reach, F.lit(0)), F.least(i, F.size("words") - n))))
        candidates.append(_windows(F.col("words"), F.array_distinct(starts), n))
    none = F.array().cast("array<struct<start:int,length:int,window:string>>")
    looked = close.select("doc_id", "text_key", F.explode(F.concat(*candidates, none)).alias("w")) \
        .select("doc_id", "text_key", "w.*")
    hits = materialize(looked.join(_small(windows.select("length", "window").distinct(),
                                          F.octet_length("window") + 48), ["length", "window"], "left_semi"), "benchmark-hits")

    covered = F.aggregate(
        F.array_sort(F.collect_set(F.struct("start", "length"))),
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, s: F.struct(
            F.greatest(a["end"], s["start"] + s["length"]).alias("end"),
            (a["n"] + F.greatest(s["start"] + s["length"] - F.greatest(a["end"], s["start"]), F.lit(0)))
            .cast("long").alias("n")),
        lambda a: a["n"])
    n_hit = hits.groupBy("doc_id", "text_key").agg(covered.alias("n_hit"))
    items = hits.select("doc_id", "text_key", "length", "window").distinct() \
        .join(windows.select("length", "window", F.col("item_id").cast("string").alias("item")), ["length", "window"]) \
        .groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    found = n_hit.join(items.withColumnsRenamed({"doc_id": "i_id", "text_key": "i_key"}),
                       F.col("doc_id").eqNullSafe(F.col("i_id")) & (F.col("text_key") == F.col("i_key"))) \
        .select(F.col("doc_id").alias("f_id"), F.col("text_key").alias("f_key"), "n_hit", "items")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return printed.select("doc_id", "text_key", "n_words").join(
        found, F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("text_key") == F.col("f_key")), "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"), "text_key")


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    judged = contamination(docs, benchmark, id_col, text_col, item_col, item_text_col)
    out = _small(materialize(judged.filter("contaminated").select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct(), "contaminated"), 32)
    return docs.join(out, F.col(id_col).cast("long").eqNullSafe(F.col("__id"))
                     & (F.xxhash64(F.col(text_col).cast("string")) == F.col("__key")), "left_anti")
