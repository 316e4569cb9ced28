"""Names, labels, property lookup and repeatable pseudo-random values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlens import constants as K


def pick_property(props: Column, names: list[str]) -> Column:
    """First non-empty property: exact names in order, then the same names ignoring case."""
    def first_filled(values: Column) -> Column:
        return F.get(F.filter(values, lambda v: v.isNotNull() & (v != "")), F.lit(0))

    def ignoring_case(name: Column) -> Column:
        hits = F.filter(F.map_entries(props), lambda e: F.lower(e.key) == name)
        return F.try_element_at(hits, F.lit(-1)).value

    exact = F.array(*[F.lit(n) for n in names])
    lowered = F.array(*[F.lit(n.lower()) for n in names])
    return F.coalesce(
        first_filled(F.transform(exact, lambda n: F.try_element_at(props, n))),
        first_filled(F.transform(lowered, ignoring_case)))


def clean_zone_name(name: Column) -> Column:
    """Readable zone name: no parenthesis, no Arabic tail, no administrative prefix."""
    cut = F.trim(F.element_at(F.split(F.trim(name), r"\("), 1))
    cut = F.trim(F.regexp_replace(cut, r"(?s)[؀-ۿ].*$", ""))
    alternatives = "|".join(K.ZONE_NAME_PREFIXES)
    bare = F.trim(F.regexp_replace(cut, f"(?iu)^({alternatives})", ""))
    spaced = F.regexp_replace(bare, r"\s+", " ")
    return F.coalesce(F.nullif(F.btrim(spaced, F.lit(" -_'")), F.lit("")), F.lit("unknown"))


def status_label(status: Column) -> Column:
    """Display label of a vehicle state; unknown states are shown upper-cased in brackets."""
    known = reduce(
        lambda expr, item: expr.when(status == item[0], item[1]),
        list(K.STATUS_LABELS.items())[1:],
        F.when(status == next(iter(K.STATUS_LABELS)), next(iter(K.STATUS_LABELS.values()))),
    )
    return known.otherwise(F.concat(F.lit("["), F.upper(F.coalesce(status, F.lit("unknown"))), F.lit("]")))


def anomaly_label(anomaly: Column) -> Column:
    """Missing or empty anomaly types read as ``normal``."""
    return F.coalesce(F.nullif(anomaly, F.lit("")), F.lit("normal"))


def stable_number(key: Column, modulus: int) -> Column:
    """Number 0..modulus-1 derived from a key, so replays and retries agree."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % modulus


def stable_order(key: Column, seed: int) -> Column:
    """Sort value that shuffles rows the same way for the same seed."""
    return F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))))
