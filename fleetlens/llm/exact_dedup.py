"""Exact deduplication by recipes of content-defined chunks, with SQL functions only.

A normalised text is cut after the first punctuation mark and white space beyond a least length. Distinct
chunks are brought together once, to verify that a chunk identifier stands for one content; documents are
then compared by their ordered identifier lists, so that a long text never moves as a whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.text import lower_ascii, picked
from fleetlens.session import materialize

#: Characters of a chunk: at least, and at most where no boundary comes.
SHORTEST, LONGEST = 512, 4096
#: Tasks that share the rows of a group of copies.
SALTS = 16


def chunks(text: Column, shortest: int = SHORTEST, longest: int = LONGEST) -> Column:
    """``text`` in pieces whose ends depend on the content near them; an empty text has none."""
    return F.regexp_extract_all(
        text, F.lit(rf"(?s).{{{shortest},{longest}}}?(?<=[.,;:!?]\s)|.{{1,{longest}}}"), F.lit(0))


def _clashes(cut: DataFrame, identifier: Callable[[Column], Column]) -> DataFrame | None:
    """Chunks whose identifier stands for several contents, numbered within the identifier; None if there are none."""
    contents = cut.select(F.explode("chunks").alias("chunk")).distinct() \
        .select(identifier(F.col("chunk")).alias("chunk_id"), "chunk")
    shared = materialize(contents.groupBy("chunk_id").count().filter("count > 1").select("chunk_id"), "chunk-clashes")
    if shared.isEmpty():
        return None
    numbered = F.row_number().over(Window.partitionBy("chunk_id").orderBy("chunk"))
    return contents.join(shared, "chunk_id", "left_semi").withColumn("content", numbered)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 identifier: Callable[[Column], Column] = F.xxhash64, every_row: bool = False) -> DataFrame:
    """One row per document, or per row of ``docs`` if ``every_row``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z. The row with the largest id of equal texts stays.
    A null text counts as empty. A null id ranks below every other and stays only if all ids of its group are
    null. Rows that repeat both id and normalised text are one document; with ``every_row`` each of them comes
    back and counts in group_size. Other columns are ignored. ``identifier`` names chunks; clashes of names are found and resolved by content.
    """
    norm = picked(docs, id_col, text_col).select("doc_id", lower_ascii(F.col("text")).alias("norm"))
    cut = norm.select("doc_id", F.sha2("norm", 256).alias("text_sha256"), chunks(F.col("norm")).alias("chunks"))
    clashes = _clashes(cut, identifier)
    recipes = cut.select("doc_id", "text_sha256",
                         F.transform("chunks", lambda c: identifier(c)).alias("recipe"))
    if clashes is not None:
        # Documents with an ambiguous chunk say in a second list which content each one has.
        marks = cut.select("doc_id", "text_sha256", F.posexplode("chunks").alias("pos", "chunk")) \
            .join(clashes.select("chunk", "content"), "chunk") \
            .groupBy("doc_id", "text_sha256") \
            .agg(F.sort_array(F.collect_set(F.struct("pos", "content"))).alias("contents"))
        marks = marks.withColumnsRenamed({"doc_id": "mark_id", "text_sha256": "mark_sha"})
        recipes = recipes.join(marks, F.col("doc_id").eqNullSafe(F.col("mark_id"))
                               & (F.col("text_sha256") == F.col("mark_sha")), "left") \
            .select("doc_id", "text_sha256", F.struct("recipe", "contents").alias("recipe"))
    if not every_row:
        recipes = recipes.dropDuplicates(["doc_id", "recipe"])
    groups = recipes.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")) \
        .filter("group_size > 1")
    # A group of copies may be a large part of all rows: each row joins one of SALTS copies of its group.
    groups = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    recipes = recipes.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    single = F.col("group_size").isNull()
    keep_id = F.when(single, F.col("doc_id")).otherwise(F.col("keep_id"))
    return recipes.join(groups, ["recipe", "salt"], "left").select(
        "doc_id", keep_id.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"), "text_sha256")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows that repeat id and text one stays."""
    def key(doc_id: Column, sha256: Column) -> Column:
        return F.concat_ws("-", doc_id.cast("long").cast("string"), sha256)

    kept = exact_groups(docs, id_col, text_col).filter("kept") \
        .select(key(F.col("doc_id"), F.col("text_sha256")).alias("__key"))
    keyed = docs.withColumn("__key", key(F.col(id_col), F.sha2(lower_ascii(F.col(text_col).cast("string")), 256)))
    return keyed.join(kept, "__key", "left_semi").dropDuplicates(["__key"]).drop("__key")
