"""K-Means of several groups with all restarts at once.

The points are first summed into cells: on each axis a histogram of ``FINE`` equal steps gives ``COARSE`` ranges of about
equal weight, so a group has at most ``COARSE`` squared cells however many points it has, small where points are dense. Every
restart is seeded and fitted on the cells of its group, a task each. From there the steps go over the points themselves:
each is one aggregation for all groups and restarts that still move, in which a task sends one row per centre. Coordinates
are whole numbers of 1 / ``UNIT`` and the sums exact, so neither retries nor partitioning change a result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNIT = 1 << 20
FINE, COARSE = 4096, 160  # steps of an axis, ranges of an axis; with two axes at most 25,600 cells a group

Centres = dict[tuple[str, int], np.ndarray]  # by group and restart


class Fit(NamedTuple):
    centres: np.ndarray
    members: np.ndarray
    cost: float


def on_grid(values: np.ndarray) -> np.ndarray:
    return np.rint(np.asarray(values, dtype="float64") * UNIT).astype("int64")


def _nearest(at: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label of the closest centre (the first of equals) and the squared distance to it."""
    places = (at / UNIT).T
    away = np.stack([sum((x - c) ** 2 for x, c in zip(places, centre)) for centre in centres])
    label = away.argmin(axis=0)
    return label, away[label, np.arange(len(at))]


def _by_group(chunks: Iterator[pd.DataFrame], cols: Sequence[str]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    for pdf in chunks:
        for name, rows in pdf.groupby("grp"):
            yield name, rows[list(cols)].to_numpy("int64"), rows["weight"].to_numpy("int64")


def _ranges(points: DataFrame, cols: Sequence[str]) -> dict[tuple[str, str], tuple[int, int, np.ndarray]]:
    """By group and axis: least value, width of a step, and the range of each step."""
    ends = [f(c).alias(f"{c}{name}") for c in cols for name, f in (("_low", F.min), ("_high", F.max))]
    low = {
        (r["grp"], c): (r[f"{c}_low"], (r[f"{c}_high"] - r[f"{c}_low"]) // FINE + 1)
        for r in points.groupBy("grp").agg(*ends).collect() for c in cols
    }

    def count(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = {key: np.zeros(FINE, dtype="int64") for key in low}
        for name, at, weight in _by_group(chunks, cols):
            for column, c in zip(at.T, cols):
                least, width = low[name, c]
                np.add.at(totals[name, c], (column - least) // width, weight)
        for (name, c), total in totals.items():
            used = np.flatnonzero(total)
            yield pd.DataFrame({"grp": name, "axis": c, "step": used.astype("int32"), "n": total[used]})

    histogram = {key: np.zeros(FINE) for key in low}
    steps = points.mapInPandas(count, "grp string, axis string, step int, n bigint").groupBy("grp", "axis", "step")
    for r in steps.agg(F.sum("n").alias("n")).collect():  # at most FINE rows for a group and axis
        histogram[r["grp"], r["axis"]][r["step"]] = r["n"]
    return {
        key: (*low[key], ((np.cumsum(n) - n / 2) / n.sum() * COARSE).astype("int64").clip(0, COARSE - 1)) for key, n in histogram.items()
    }


def cells_of(points: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Points summed by group and cell: ``grp``, ``cell``, ``n`` and the sums of ``cols``."""
    ranges = _ranges(points, cols)

    def add(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for name, at, weight in _by_group(chunks, cols):
            cell = np.zeros(len(at), dtype="int64")
            for column, c in zip(at.T, cols):
                least, width, of_step = ranges[name, c]
                cell = cell * COARSE + of_step[(column - least) // width]
            sums = {c: column * weight for column, c in zip(at.T, cols)}
            yield pd.DataFrame({"grp": name, "cell": cell, "n": weight, **sums}).groupby(["grp", "cell"], as_index=False).sum()

    sums = ", ".join(f"{c} bigint" for c in cols)
    parts = points.mapInPandas(add, f"grp string, cell bigint, n bigint, {sums}").groupBy("grp", "cell")
    return parts.agg(*[F.sum(c).alias(c) for c in ("n", *cols)])


def fit_cells(at: np.ndarray, weight: np.ndarray, k: int, iterations: int, tolerance: float, rng: np.random.Generator) -> np.ndarray:
    """``k`` centres of weighted places: each next one drawn by weight times squared distance, then steps until they rest."""
    picked = [int(rng.choice(len(at), p=weight / weight.sum()))]
    away = ((at - at[picked[0]]) ** 2).sum(axis=1)
    while len(picked) < k:
        rate = away * weight
        picked.append(int(rng.choice(len(at), p=rate / rate.sum())) if rate.sum() > 0 else picked[0])
        away = np.minimum(away, ((at - at[picked[-1]]) ** 2).sum(axis=1))
    centres = at[picked]
    for _ in range(iterations):
        label = np.stack([((at - centre) ** 2).sum(axis=1) for centre in centres]).argmin(axis=0)
        sums = np.column_stack([np.bincount(label, weight * column, k) for column in at.T])
        after = _moved(centres, np.bincount(label, weight, k), sums)
        rest = (((after - centres) ** 2).sum(axis=1) <= tolerance**2).all()
        centres = after
        if rest:
            break
    return centres


def seeded(
    points: DataFrame, cols: Sequence[str], k: int, restarts: int, iterations: int, tolerance: float, seed: int
) -> Centres:
    """Centres of every group and restart, fitted on the group's cells in one job."""

    def start(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("cell")
        name, restart, n = pdf["grp"].iloc[0], int(pdf["restart"].iloc[0]), pdf["n"].to_numpy("float64")
        at = pdf[list(cols)].to_numpy("float64") / n[:, None] / UNIT
        centres = fit_cells(at, n, k, iterations, tolerance, np.random.default_rng([seed, restart, *name.encode()]))
        out = pd.DataFrame(centres, columns=list(cols))
        return out.assign(grp=name, restart=restart, label=np.arange(k))[["grp", "restart", "label", *cols]]

    each = F.explode(F.array(*[F.lit(r) for r in range(restarts)])).alias("restart")
    tried = cells_of(points, cols).select("*", each).groupBy("grp", "restart")
    schema = "grp string, restart int, label int, " + ", ".join(f"{c} double" for c in cols)
    found = tried.applyInPandas(start, schema).collect()  # a row per centre
    out: Centres = {}
    for r in sorted(found):
        out.setdefault((r["grp"], r["restart"]), []).append([r[c] for c in cols])
    return {key: np.array(rows) for key, rows in out.items()}


def _sums(points: DataFrame, cols: Sequence[str], centres: Centres) -> dict[tuple[str, int], tuple[np.ndarray, np.ndarray, float]]:
    """Points, sums of coordinates and cost of every centre's points: one job for all groups and restarts."""

    def add(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = {key: np.zeros((len(there), len(cols) + 2), dtype="int64") for key, there in centres.items()}
        for name, at, weight in _by_group(chunks, cols):
            for key, there in centres.items():
                if key[0] == name:
                    label, away = _nearest(at, there)
                    parts = np.column_stack([weight, at * weight[:, None], on_grid(away) * weight])
                    totals[key] += (label[:, None] == np.arange(len(there))).astype("int64").T @ parts
        for (name, restart), rows in totals.items():
            out = pd.DataFrame(rows, columns=["n", *cols, "cost"])
            out = out.assign(grp=name, restart=restart, label=np.arange(len(rows)))
            yield out.loc[out["n"] > 0, ["grp", "restart", "label", "n", *cols, "cost"]]

    schema = "grp string, restart int, label int, n bigint, " + ", ".join(f"{c} bigint" for c in (*cols, "cost"))
    parts = points.mapInPandas(add, schema).groupBy("grp", "restart", "label")
    out = {key: np.zeros((len(there), len(cols) + 2)) for key, there in centres.items()}
    for r in parts.agg(*[F.sum(c).alias(c) for c in ("n", *cols, "cost")]).collect():  # a row per centre
        out[r["grp"], r["restart"]][r["label"]] = [r["n"], *(r[c] for c in cols), r["cost"]]
    return {key: (t[:, 0], t[:, 1:-1] / UNIT, float(t[:, -1].sum()) / UNIT) for key, t in out.items()}


def _moved(there: np.ndarray, n: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Means of the points of each centre; a centre without points stays."""
    return np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], there)


def fit(
    points: DataFrame, cols: Sequence[str], k: int, restarts: int, iterations: int, tolerance: float, seed: int
) -> dict[str, Fit]:
    """The cheapest of ``restarts`` fits of each group. ``points``: ``grp``, ``weight`` and ``cols`` on the grid, as bigint.

    Groups are few, each with more than ``k`` distinct points. A fit that moved no centre by more than ``tolerance``
    rests while the others go on. Equal costs: the earlier restart. An empty table has no groups.
    """
    centres = seeded(points, cols, k, restarts, iterations, tolerance / 10, seed)
    moving = set(centres)
    for _ in range(iterations):
        for key, (n, sums, _) in _sums(points, cols, {key: centres[key] for key in moving}).items():
            after = _moved(centres[key], n, sums)
            if (((after - centres[key]) ** 2).sum(axis=1) <= tolerance**2).all():
                moving.discard(key)
            centres[key] = after
        if not moving:
            break
    if not centres:
        return {}
    best: dict[str, Fit] = {}
    for (group, restart), (n, _, cost) in sorted(_sums(points, cols, centres).items()):
        if group not in best or cost < best[group].cost:
            best[group] = Fit(centres[group, restart], n, cost)
    return best
