"""Smoothing a trajectory by a motion model: constant velocity, disturbed by random acceleration.

What is known about a stretch of points is a quadratic form in the state before its first point and the state at
its last one. Two neighbouring stretches combine into one by eliminating the state between them, in any grouping, so
a long trip is cut into blocks that are reduced at once and combined in pairs. A state is (position, velocity); both
coordinates share the matrices and have a column each in the linear terms.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.session import materialize

POINTS_PER_BLOCK = 512
ROWS_IN_STEP = 1024  # rows of a batch that are walked together
_FORM = "form array<double>"  # ii, io, oo, h_i, h_o: five 2 x 2 matrices


class Model(NamedTuple):
    """Matrices of one step: ``f`` moves a state on, ``q`` is the inverse of the step's noise."""

    f: np.ndarray
    q: np.ndarray
    seen: np.ndarray
    start: np.ndarray


def model(noise_m: float, density: float, speed_ms: float, seconds: float) -> Model:
    """``noise_m``: deviation of a measured position; ``density``: of the acceleration, in m^2/s^3; ``speed_ms``: deviation
    of the velocity before the first point. Only their ratios count, so positions may be in degrees."""
    t = float(seconds)
    return Model(
        np.array([[1.0, t], [0.0, 1.0]]), np.array([[12 / t**3, -6 / t**2], [-6 / t**2, 4 / t]]) / density,
        np.array([[1 / noise_m**2, 0.0], [0.0, 0.0]]), np.array([[0.0, 0.0], [0.0, 1 / speed_ms**2]]))


def _inverse(m: np.ndarray) -> np.ndarray:
    """Inverses of many 2 x 2 matrices."""
    a, b, c, d = m[:, 0, 0], m[:, 0, 1], m[:, 1, 0], m[:, 1, 1]
    return np.stack([np.stack([d, -b], -1), np.stack([-c, a], -1)], -2) / (a * d - b * c)[:, None, None]


def combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The forms of stretches and of those right after them, (rows, 5, 2, 2) each, as forms of both together."""
    ii, io, oo, hi, ho = (left[:, k] for k in range(5))
    ii2, io2, oo2, hi2, ho2 = (right[:, k] for k in range(5))
    between = _inverse(oo + ii2)
    into, out, h = io @ between, io2.transpose(0, 2, 1) @ between, ho + hi2
    return np.stack([ii - into @ io.transpose(0, 2, 1), -into @ io2, oo2 - out @ io2, hi - into @ h, ho2 - out @ h], 1)


def _measured(z: np.ndarray, by: Model) -> tuple[np.ndarray, np.ndarray]:
    """What points say of their own states: (rows, 2, 2) twice; points without a position say nothing."""
    known = ~np.isnan(z).any(1)
    h = np.zeros((len(z), 2, 2))
    h[:, 0] = np.where(known[:, None], z, 0.0) * by.seen[0, 0]
    return by.seen * known[:, None, None], h


def _steps(z: np.ndarray, by: Model) -> np.ndarray:
    """The forms of single points that have a point before them."""
    seen, h = _measured(z, by)
    back = by.f.T @ by.q
    of = lambda m: np.broadcast_to(m, (len(z), 2, 2))
    return np.stack([of(back @ by.f), of(-back), by.q + seen, np.zeros_like(h), h], 1)


def _in_step(lat: pd.Series, lon: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of like length together: their numbers, lengths and positions, padded with nan to (rows, points, 2)."""
    sizes = lat.map(len).to_numpy()
    order = np.argsort(sizes, kind="stable")
    for at in range(0, len(order), ROWS_IN_STEP):
        part = order[at:at + ROWS_IN_STEP]
        z = np.full((len(part), sizes[part].max(), 2), np.nan)
        for row, k in enumerate(part):
            z[row, :sizes[k], 0], z[row, :sizes[k], 1] = lat.iloc[k], lon.iloc[k]
        yield part, sizes[part], z


def _reduce(lat: pd.Series, lon: pd.Series, first: np.ndarray, by: Model) -> np.ndarray:
    """One form per block of points."""
    forms = np.zeros((len(lat), 5, 2, 2))
    for part, sizes, z in _in_step(lat, lon):
        form = _steps(z[:, 0], by)
        seen, h = _measured(z[:, 0], by)
        begins = first[part]
        form[begins] = 0.0  # nothing comes before the first point of a trip
        form[begins, 2], form[begins, 4] = (seen + by.start)[begins], h[begins]
        for k in range(1, z.shape[1]):
            more = sizes > k
            form[more] = combine(form[more], _steps(z[more, k], by))
        forms[part] = form
    return forms


def _stacked(forms: pd.Series) -> np.ndarray:
    """Forms as (rows, 5, 2, 2), zeros where there is none."""
    return np.stack([np.zeros(20) if form is None else form for form in forms]).reshape(-1, 5, 2, 2)


def _about_the_state_before(forms: np.ndarray) -> np.ndarray:
    """What stretches say of the state before them, whatever their last state is."""
    ii, io, oo, hi, ho = (forms[:, k] for k in range(5))
    into = io @ _inverse(np.where(oo.any((1, 2), keepdims=True), oo, np.eye(2)))
    return np.stack([ii - into @ io.transpose(0, 2, 1), hi - into @ ho], 1)


def _positions(z: np.ndarray, sizes: np.ndarray, before: np.ndarray, begins: np.ndarray, after: np.ndarray, by: Model) -> np.ndarray:
    """Smoothed positions, from what the points before and after a block say of the states at its ends.

    ``before`` and ``after``: (rows, 2, 2, 2), a matrix and linear terms each; ``before`` counts where not ``begins``.
    """
    rows, most = z.shape[:2]
    matrix, linear, forth = np.zeros((rows, most, 2, 2)), np.zeros((rows, most, 2, 2)), by.q @ by.f
    m, h = before[:, 0], before[:, 1]
    for k in range(most):
        seen, said = _measured(z[:, k], by)
        on = forth @ _inverse(m + by.f.T @ forth)
        start = (begins if k == 0 else np.zeros(rows, bool))[:, None, None]
        m = np.where(start, by.start, by.q - on @ forth.T) + seen
        h = np.where(start, 0.0, on @ h) + said
        matrix[:, k], linear[:, k] = m, h
    m, h = after[:, 0], after[:, 1]
    for k in range(most - 1, -1, -1):
        inside = sizes > k
        matrix[inside, k] += m[inside]
        linear[inside, k] += h[inside]
        seen, said = _measured(z[:, k], by)
        back = forth.T @ _inverse(m + seen + by.q)
        m = np.where(inside[:, None, None], by.f.T @ forth - back @ forth, m)
        h = np.where(inside[:, None, None], back @ (h + said), h)
    with np.errstate(divide="ignore", invalid="ignore"):  # padding, and trips without any position
        states = _inverse(matrix.reshape(-1, 2, 2)) @ linear.reshape(-1, 2, 2)
    return states[:, 0].reshape(rows, most, 2)


def _fold(forms: DataFrame, forwards: bool) -> DataFrame:
    """trip_id, block, form of all blocks up to each one (or from each one on), in log2(blocks of a trip) rounds."""
    most, span = forms.agg(F.max("block")).first()[0] or 0, 1

    @F.pandas_udf("array<double>")
    def join(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series(list(combine(_stacked(left), _stacked(right)).reshape(-1, 20)) if len(left) else [], dtype=object)

    while span <= most:
        near = forms.select("trip_id", (F.col("block") + (span if forwards else -span)).alias("block"), F.col("form").alias("other"))
        pairs = forms.join(near, ["trip_id", "block"], "left")
        both = join(*(("other", "form") if forwards else ("form", "other")))
        whole = pairs.filter("other IS NULL").select("trip_id", "block", "form")
        forms = materialize(whole.unionByName(pairs.filter("other IS NOT NULL").select("trip_id", "block", both.alias("form"))), "motion-fold")
        span *= 2
    return forms


def smooth(points: DataFrame, noise_m: float = 10.0, density: float = 0.5, speed_ms: float = 15.0,
           seconds: int = K.GPS_INTERVAL_SECONDS) -> DataFrame:
    """Add motion_lat and motion_lon: the most likely positions given all points of the trip.

    ``points``: trip_id, point_index, lat, lon and others; the index counts from 0 without gaps and points are ``seconds``
    apart. A point without a position gets the most likely one; a trip without any has none.
    """
    size, by = POINTS_PER_BLOCK, model(noise_m, density, speed_ms, seconds)
    known = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    place = F.struct("point_index", *[F.when(known, F.col(c)).otherwise(F.lit(float("nan"))).alias(c) for c in ("lat", "lon")])
    blocks = materialize(
        points.groupBy("trip_id", F.floor(F.col("point_index") / size).alias("block"))
        .agg(F.sort_array(F.collect_list(place)).alias("p"), F.count(F.when(known, 1)).alias("known"))
        .select("trip_id", "block", "known", F.col("p.lat").alias("lats"), F.col("p.lon").alias("lons")), "motion-blocks")

    def reduced(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            forms = _reduce(f["lats"], f["lons"], (f["block"] == 0).to_numpy(), by)
            yield f[["trip_id", "block"]].assign(form=list(forms.reshape(-1, 20)))

    def smoothed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            before, after = (_stacked(f[c]) for c in ("before", "after"))
            after = _about_the_state_before(after)
            for part, sizes, z in _in_step(f["lats"], f["lons"]):
                at = _positions(z, sizes, before[part][:, [2, 4]], (f["block"] == 0).to_numpy()[part], after[part], by)
                none = f["known_in_trip"].to_numpy()[part] == 0
                yield pd.DataFrame({
                    "trip_id": f["trip_id"].iloc[part].repeat(sizes).to_numpy(),
                    "point_index": np.concatenate([b * size + np.arange(n) for b, n in zip(f["block"].iloc[part], sizes)]),
                    **{c: np.concatenate([np.where(gone, np.nan, p[:n, k]) for p, n, gone in zip(at, sizes, none)])
                       for k, c in enumerate(("motion_lat", "motion_lon"))}})

    key = dict(points.select("trip_id").dtypes)["trip_id"]
    no_form = F.lit(None).cast("array<double>")
    ready = blocks.withColumns({"before": no_form, "after": no_form, "known_in_trip": F.col("known")})
    trips = blocks.filter("block > 0").select("trip_id").distinct()
    if not trips.isEmpty():
        long = blocks.join(trips, "trip_id", "left_semi")
        forms = materialize(long.mapInPandas(reduced, f"trip_id {key}, block long, {_FORM}"), "motion-forms")
        before = _fold(forms, True).select("trip_id", (F.col("block") + 1).alias("block"), F.col("form").alias("before"))
        after = _fold(forms, False).select("trip_id", (F.col("block") - 1).alias("block"), F.col("form").alias("after"))
        counts = long.groupBy("trip_id").agg(F.sum("known").alias("known_in_trip"))
        ready = ready.join(trips, "trip_id", "left_anti").unionByName(
            long.join(before, ["trip_id", "block"], "left").join(after, ["trip_id", "block"], "left").join(counts, "trip_id"))
    found = ready.mapInPandas(smoothed, f"trip_id {key}, point_index long, motion_lat double, motion_lon double")
    places = [F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("motion_lat", "motion_lon")]
    return points.join(found.select("trip_id", "point_index", *places), ["trip_id", "point_index"])
