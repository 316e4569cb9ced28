"""Column helpers for text, as expressions that stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z in lower case and everything else unchanged; null becomes empty.

    Texts of ASCII characters alone take the faster general lower-casing, which is the same for them.
    """
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)) \
        .otherwise(F.translate(text, UPPER, LOWER))


def picked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator needs, as ``doc_id`` and ``text``; other columns cannot clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` worked out once, also where ``then`` uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), lambda v: then(v)), 1)
