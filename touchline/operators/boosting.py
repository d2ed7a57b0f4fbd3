"""Second-order boosted trees on binned features.

Rows are read twice, however many there are. One aggregate finds the edges of the bins, one counts rows and positives of
every cell, that is every combination of bins that occurs; the counts are partial in each task, so a cell is shuffled once a
task at most. What is left to fit is bounded by the bins and not by the rows: a cell more or less costs the same whether ten
or ten billion rows are in it. All models that share the cells (the folds of a calibrated model) are fitted side by side, one
task for each, instead of a job for every level of every tree.

Where nearly every row is a cell of its own, the bins are no bound worth having. :func:`train_shared` then deals the cells to all
tasks, and level by level the driver adds up a histogram from each of them.

A tree's split maximises the second-order gain over histograms of gradients and hessians, with an L2 term on the leaves and a
least sum of hessians for a child. Each tree sees a binomial share of the rows of each cell and a share of the features.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from touchline.functions.numeric import round_pos
from touchline.operators.metrics import classifier_metrics
from touchline.session import materialise

BINS = 254  # bins of a feature, beside one for missing values: a bin is one byte
ALL_LEFT = 255  # a cut above every bin: the node is not split
SHARD = 1 << 16  # rows of a shared fit that are drawn and summed together
UNIT = float(1 << 24)  # sums of shards are added as whole numbers of this part, so it does not matter which task has which
TREES_STORED = 100  # trees after which a shared fit writes its margins


@dataclass(frozen=True)
class TreeSettings:
    trees: int
    depth: int
    rate: float = 0.05
    subsample: float = 0.8
    columns: float = 0.8
    l2: float = 1.0
    least_hessian: float = 1.0


# --- cells ------------------------------------------------------------------------------------------------


def bin_edges(rows: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Ascending edges of every feature, at most ``bins - 1``: a value belongs to the first edge that is not below it."""
    values = [F.col(f).cast("double") for f in features]
    shares = [i / bins for i in range(1, bins)]
    found = rows.agg(*(F.percentile_approx(F.when(~F.isnan(v), v), shares, 10_000).alias(f"_{i}") for i, v in enumerate(values))).first()
    return [sorted(set(e or [])) for e in found]


def binned(values: np.ndarray, edges: Sequence[float]) -> np.ndarray:
    """Bin of every value: 0 for a missing one, then the number of edges below it plus one."""
    out = np.searchsorted(np.asarray(edges, float), values, side="left").astype(np.uint8) + np.uint8(1)
    out[np.isnan(values)] = 0
    return out


def _matrix(columns: Sequence[pd.Series], edges: Sequence[Sequence[float]]) -> np.ndarray:
    return np.column_stack([binned(c.to_numpy(dtype=float, na_value=np.nan), e) for c, e in zip(columns, edges)])


def cell(features: Sequence[str], edges: list[list[float]]) -> Column:
    """The bins of all features, a byte each."""

    @pandas_udf("binary")
    def bins(*columns: pd.Series) -> pd.Series:
        found = np.ascontiguousarray(_matrix(columns, edges))
        data, width = found.tobytes(), found.shape[1]
        return pd.Series([data[i : i + width] for i in range(0, len(data), width)])

    return bins(*(F.col(f).cast("double") for f in features))


def cells(rows: DataFrame, features: Sequence[str], edges: list[list[float]], label: str, part: str) -> DataFrame:
    """``cell, part, n, pos``: rows and positives of every combination of bins, for each value of the column ``part``."""
    keys = rows.select(cell(features, edges).alias("cell"), F.col(part).cast("int").alias("part"), F.col(label).cast("long").alias("y"))
    return keys.groupBy("cell", "part").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos"))


# --- trees ------------------------------------------------------------------------------------------------


def best_splits(grad: np.ndarray, hess: np.ndarray, l2: float, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature, bin and gain of the best split of every node; a gain of 0 where none is allowed or none gains.

    ``grad`` and ``hess`` are sums by (node, feature, bin). Bins up to the cut go left. Of equal gains the first feature,
    then the first bin counts.
    """
    nodes, _, bins = grad.shape
    g, h = np.cumsum(grad, axis=2), np.cumsum(hess, axis=2)
    whole_g, whole_h = g[:, :, -1:], h[:, :, -1:]
    gain = g * g / (h + l2) + (whole_g - g) ** 2 / (whole_h - h + l2) - whole_g**2 / (whole_h + l2)
    gain = np.where((h >= least) & (whole_h - h >= least), gain, 0.0).reshape(nodes, -1)
    at = gain.argmax(axis=1)
    best = gain[np.arange(nodes), at]
    return at // bins, at % bins, np.where(best > 1e-12, best, 0.0)


@dataclass
class Ensemble:
    """Complete trees level by level: inner node k has the children 2k + 1 and 2k + 2; leaves hold shrunk weights."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    slope: float = 1.0
    intercept: float = 0.0

    def margins(self, bins: np.ndarray) -> np.ndarray:
        rows, out = np.arange(len(bins)), np.full(len(bins), self.base)
        inner = self.feature.shape[1]
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(bins), np.int64)
            while len(bins) and node[0] < inner:
                node = 2 * node + 1 + (bins[rows, feature[node]] > cut[node])
            out += leaf[node - inner]
        return out

    def probability(self, bins: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.margins(bins) + self.intercept)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


def histograms(at: list[np.ndarray], grad: np.ndarray, hess: np.ndarray, nodes: int, width: int) -> np.ndarray:
    """Sums of gradients and hessians by (node, feature, bin); ``at`` has node times ``width`` plus bin for each feature."""
    out = np.empty((2, nodes, len(at), width))
    for i, places in enumerate(at):
        for j, weight in enumerate((grad, hess)):
            out[j, :, i] = np.bincount(places, weight, nodes * width).reshape(nodes, width)
    return out


def grow(bins: np.ndarray, n: np.ndarray, pos: np.ndarray, settings: TreeSettings, seed: Sequence[int]) -> Ensemble:
    """Boosted trees for the log loss of ``n`` rows with ``pos`` positives in each cell."""
    rng = np.random.default_rng(list(seed))
    width = int(bins.max(initial=0)) + 1
    columns = [bins[:, f].astype(np.int64) for f in range(bins.shape[1])]
    wanted = max(1, int(settings.columns * len(columns)))
    share = min(max(pos.sum() / max(n.sum(), 1), 1e-6), 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    margin = np.full(len(n), base)
    inner = 2**settings.depth - 1
    feature, cut = np.zeros((settings.trees, inner), np.int32), np.full((settings.trees, inner), ALL_LEFT, np.int32)
    leaf = np.zeros((settings.trees, inner + 1))
    for t in range(settings.trees):
        p = sigmoid(margin)
        good, bad = rng.binomial(pos, settings.subsample), rng.binomial(n - pos, settings.subsample)
        grad, hess = (good + bad) * p - good, (good + bad) * p * (1 - p)
        chosen = np.sort(rng.choice(len(columns), wanted, replace=False))
        node = np.zeros(len(n), np.int64)
        for level in range(settings.depth):
            k = 2**level
            if level == 0:
                sums = histograms([columns[f] for f in chosen], grad, hess, 1, width)
            else:  # only the smaller child of each node is summed; the other one is the rest of its parent
                pairs = np.bincount(node, minlength=k).reshape(-1, 2)
                small = pairs.argmin(axis=1)
                rows = np.flatnonzero(small[node >> 1] == (node & 1))
                up = (node[rows] >> 1) * width
                part = histograms([up + columns[f][rows] for f in chosen], grad[rows], hess[rows], k // 2, width)
                first = (small == 0)[None, :, None, None]
                sums = np.stack([np.where(first, part, sums - part), np.where(first, sums - part, part)], axis=2)
                sums = sums.reshape(2, k, wanted, width)
            where, edge, gain = best_splits(sums[0], sums[1], settings.l2, settings.least_hessian)
            split = gain > 0
            feature[t, k - 1 : 2 * k - 1] = np.where(split, chosen[where], 0)
            cut[t, k - 1 : 2 * k - 1] = np.where(split, edge, ALL_LEFT)
            own = feature[t, k - 1 + node]
            node = 2 * node + (bins[np.arange(len(n)), own] > cut[t, k - 1 + node])
        down, up = np.bincount(node, grad, inner + 1), np.bincount(node, hess, inner + 1)
        leaf[t] = -settings.rate * down / (up + settings.l2)
        margin += leaf[t][node]
    return Ensemble(base, feature, cut, leaf)


def platt(margin: np.ndarray, n: np.ndarray, pos: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the sigmoid that fits the margins, by Newton steps on the smoothed targets."""
    good, all_ = pos.sum(), n.sum()
    high, low = (good + 1) / (good + 2), 1 / (all_ - good + 2)
    target = pos * high + (n - pos) * low
    theta, x = np.array([1.0, 0.0]), np.column_stack([margin, np.ones(len(margin))])

    def loss(at: np.ndarray) -> float:
        z = x @ at
        return float((n * np.logaddexp(0, z) - target * z).sum())

    for _ in range(100):
        p = sigmoid(x @ theta)
        slope = x.T @ (n * p - target)
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + 1e-9 * np.eye(2), slope)
        size = 1.0
        while size > 1e-6 and loss(theta - size * step) > loss(theta):
            size /= 2
        theta = theta - size * step
        if np.abs(size * step).max() < 1e-10:
            break
    return float(theta[0]), float(theta[1])


def held_out(p: np.ndarray, n: np.ndarray, pos: np.ndarray) -> dict[str, float | None]:
    """AUC (ties count half), log loss and Brier score of cells that a model has not seen."""
    values, at = np.unique(p, return_inverse=True)
    good, bad = np.bincount(at, pos, len(values)), np.bincount(at, n - pos, len(values))
    below = np.cumsum(bad) - bad
    pairs, rows = good.sum() * bad.sum(), n.sum()
    q = np.clip(p, 1e-15, 1 - 1e-15)
    return {
        "auc": float((good * (below + bad / 2)).sum() / pairs) if pairs else None,
        "log_loss": float(-(pos * np.log(q) + (n - pos) * np.log(1 - q)).sum() / rows) if rows else None,
        "brier_score": float((pos * (1 - p) ** 2 + (n - pos) * p**2).sum() / rows) if rows else None,
    }


# --- trees that tasks share -------------------------------------------------------------------------------


class Shard(NamedTuple):
    """Cells that are drawn and summed together, with the margin of the trees so far: those with label 0, then those with 1."""

    number: int
    zeros: int
    bins: bytes  # feature after feature
    several: bytes  # places of the cells that have more than one row
    counts: bytes  # rows of these
    margin: bytes

    def columns(self, features: int) -> np.ndarray:
        return np.frombuffer(self.bins, np.uint8).reshape(features, -1)

    def margins(self) -> np.ndarray:
        return np.frombuffer(self.margin, np.float32)

    def repeated(self) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(self.several, np.int32), np.frombuffer(self.counts, np.int64)

    def rows(self) -> tuple[int, int]:
        """Rows, and those with label 1."""
        (at, n), size = self.repeated(), len(self.margins())
        return size + int((n - 1).sum()), size - self.zeros + int((n - 1)[at >= self.zeros].sum())

    def gradients(self, settings: TreeSettings, seed: Sequence[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Gradient and hessian of the drawn rows of each cell, and whether any is drawn: the same whenever asked for a tree."""
        rng, p = np.random.default_rng([*seed, self.number]), sigmoid(self.margins())
        drawn = (rng.random(len(p), np.float32) < settings.subsample).astype(np.float32)
        at, n = self.repeated()
        drawn[at] = rng.binomial(n, settings.subsample)
        grad = drawn * p
        hess = grad * (1 - p)
        grad[self.zeros :] -= drawn[self.zeros :]
        return grad, hess, drawn > 0


def descended(columns: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """The node of each cell after so many levels of a tree, counted from 0 in its level."""
    size = columns.shape[1]
    flat, places, rows, node = columns.ravel(), feature.astype(np.int64) * size, np.arange(size), np.zeros(size, np.int64)
    for _ in range(levels):
        node = 2 * node + 1 + (flat[places[node] + rows] > cut[node])
    return node - (2**levels - 1)


@dataclass(frozen=True)
class LevelSums:
    """Histograms of one level of a tree over the shards of a task, in whole numbers.

    Of two children only the one that is ``counted`` is summed.
    """

    settings: TreeSettings
    seed: tuple[int, ...]
    feature: np.ndarray
    cut: np.ndarray
    level: int
    chosen: np.ndarray
    counted: np.ndarray
    features: int
    width: int

    def __call__(self, shards: Iterator[Shard]) -> Iterator[np.ndarray]:
        nodes = max(1, len(self.counted) // 2)
        out = np.zeros((2, nodes, len(self.chosen), self.width), np.int64)
        for shard in shards:
            columns = shard.columns(self.features)
            grad, hess, drawn = shard.gradients(self.settings, self.seed)
            if self.level == 0:
                at = [columns[f].astype(np.int64) for f in self.chosen]
            else:
                node = descended(columns, self.feature, self.cut, self.level)
                rows = np.flatnonzero(self.counted[node] & drawn)
                up = (node[rows] >> 1) * self.width
                at, grad, hess = [up + columns[f][rows] for f in self.chosen], grad[rows], hess[rows]
            grad, hess = grad.astype(float), hess.astype(float)
            out += np.rint(histograms(at, grad, hess, nodes, self.width) * UNIT).astype(np.int64)
        yield out


@dataclass(frozen=True)
class NextMargin:
    """Shards with a grown tree added to their margins."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    depth: int
    features: int

    def __call__(self, shard: Shard) -> Shard:
        at = descended(shard.columns(self.features), self.feature, self.cut, self.depth)
        return shard._replace(margin=(shard.margins() + self.leaf[at]).astype(np.float32).tobytes())


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of every cell and label in a batch, so a frequent cell is sent once a batch."""
    for batch in batches:
        counts = pa.Table.from_batches([batch]).group_by(["cell", "y"]).aggregate([("y", "count")])
        yield from counts.select(["cell", "y", "y_count"]).rename_columns(["cell", "y", "n"]).to_batches()


def _sharded(batches: Iterator[pa.RecordBatch], features: int) -> Iterator[pa.RecordBatch]:
    """The shards among a task's cells, their cells in a fixed order."""
    keys, columns = [np.empty(0, np.dtype((np.void, features)))], {k: [np.empty(0, np.int64)] for k in ("shard", "y", "n")}
    for batch in batches:
        keys.append(np.frombuffer(b"".join(batch.column("cell").to_pylist()), keys[0].dtype))
        for k, found in columns.items():
            found.append(batch.column(k).to_numpy())
    keys, (shard, y, n) = np.concatenate(keys), (np.concatenate(found) for found in columns.values())
    order = np.argsort(shard, kind="stable")
    numbers, starts = np.unique(shard[order], return_index=True)
    for number, at in zip(numbers, np.split(order, starts[1:])):
        bins, counts = [], []
        for label in (0, 1):
            mine = at[y[at] == label]
            kept, cell = np.unique(keys[mine], return_inverse=True)
            bins.append(np.frombuffer(kept.tobytes(), np.uint8).reshape(len(kept), features))
            counts.append(np.rint(np.bincount(cell, n[mine], len(kept))).astype(np.int64))
        counts, zeros = np.concatenate(counts), len(counts[0])
        several = np.flatnonzero(counts > 1).astype(np.int32)
        yield pa.RecordBatch.from_pydict({
            "number": [int(number)], "zeros": [zeros], "bins": [np.ascontiguousarray(np.concatenate(bins).T).tobytes()],
            "several": [several.tobytes()], "counts": [counts[several].tobytes()], "margin": [bytes(4 * len(counts))],
        })


_SHARD = "number long, zeros long, bins binary, several binary, counts binary, margin binary"


def _shard(row) -> Shard:
    return Shard(row[0], row[1], *map(bytes, row[2:]))


def grow_shared(
    spark: SparkSession, stored: DataFrame, features: int, width: int, settings: TreeSettings, seed: int, every: int = TREES_STORED
) -> tuple[Ensemble, int]:
    """The trees of :func:`grow` over all shards, and the rows in them; ``stored`` has the columns of :class:`Shard`.

    A job for each level: tasks send one histogram each, the driver adds them up and splits. The shards with their margins stay
    in the executors, at 12 bytes a cell; every ``every`` trees they are written, so little is grown again if an executor is lost.
    Draws belong to a shard and sums are whole numbers, so the model does not depend on the number of tasks.
    """
    rng = np.random.default_rng([seed, 0])
    wanted = max(1, int(settings.columns * features))
    begun = stored.rdd.map(_shard).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    n, pos = np.sum([(0, 0), *begun.map(Shard.rows).collect()], axis=0)  # a pair for each shard
    share = min(max(pos / max(n, 1), 1e-6), 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    inner = 2**settings.depth - 1
    feature, cut = np.zeros((settings.trees, inner), np.int32), np.full((settings.trees, inner), ALL_LEFT, np.int32)
    leaf = np.zeros((settings.trees, inner + 1))
    nothing = np.full(inner + 1, base)
    state = begun.map(NextMargin(feature[0], cut[0], nothing, settings.depth, features)).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    old = [begun]
    for t in range(settings.trees):
        chosen = np.sort(rng.choice(features, wanted, replace=False))
        counted = np.ones(1, bool)
        for level in range(settings.depth):
            k = 2**level
            work = LevelSums(settings, (seed, 0, t), feature[t], cut[t], level, chosen, counted, features, width)
            part = np.sum(state.mapPartitions(work).collect(), axis=0)  # a histogram for each task
            if level == 0:
                sums = part
                while old:
                    old.pop().unpersist()
            else:
                first = counted[::2][None, :, None, None]
                sums = np.stack([np.where(first, part, sums - part), np.where(first, sums - part, part)], axis=2)
                sums = sums.reshape(2, k, wanted, width)
            where, edge, gain = best_splits(sums[0] / UNIT, sums[1] / UNIT, settings.l2, settings.least_hessian)
            split = gain > 0
            feature[t, k - 1 : 2 * k - 1] = np.where(split, chosen[where], 0)
            cut[t, k - 1 : 2 * k - 1] = np.where(split, edge, ALL_LEFT)
            whole = sums[:, :, 0].sum(axis=2)
            left = np.where(split, np.cumsum(sums, axis=3)[:, np.arange(k), where, edge], whole)
            lighter = 2 * left[1] <= whole[1]  # the children with less hessian are summed
            counted = np.column_stack([lighter, ~lighter]).ravel()
        down, up = np.stack([left, whole - left], axis=2).reshape(2, -1) / UNIT
        leaf[t] = -settings.rate * down / (up + settings.l2)
        if t + 1 < settings.trees:
            old.append(state)
            state = state.map(NextMargin(feature[t], cut[t], leaf[t], settings.depth, features))
            if (t + 1) % every == 0:
                state = materialise(spark.createDataFrame(state, _SHARD, verifySchema=False), "shards").rdd.map(_shard)
            state = state.persist(StorageLevel.MEMORY_AND_DISK_DESER)
    for rdd in (*old, state):
        rdd.unpersist()
    return Ensemble(base, feature, cut, leaf), int(n)


# --- models -----------------------------------------------------------------------------------------------

_FIT = (
    "model int, base double, slope double, intercept double, feature array<int>, cut array<int>, leaf array<double>, "
    "n_train long, n_held long, auc double, log_loss double, brier_score double"
)


def fit(counts: DataFrame, models: int, width: int, settings: TreeSettings, calibrate: bool, seed: int) -> DataFrame:
    """A row for each model: model k learns from all cells but those of part k, and is measured on these.

    With ``calibrate`` a sigmoid is fitted on part k too. ``counts`` is :func:`cells`; a model's task holds its cells, whose
    number the bins bound.
    """

    def one(group: pa.Table) -> pa.Table:
        model = group.column("model")[0].as_py()
        keys = np.frombuffer(b"".join(group.column("cell").to_pylist()), np.dtype((np.void, width)))
        part, n, pos = (group.column(c).to_numpy() for c in ("part", "n", "pos"))

        def of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Cells in a fixed order, whatever order their rows came in."""
            kept, at = np.unique(keys[mask], return_inverse=True)
            sums = [np.rint(np.bincount(at, x[mask], len(kept))).astype(np.int64) for x in (n, pos)]
            return np.frombuffer(kept.tobytes(), np.uint8).reshape(-1, width), *sums

        seen, unseen = of(part != model), of(part == model)
        made = grow(*seen, settings, (seed, model))
        margin = made.margins(unseen[0])
        report = held_out(sigmoid(margin), *unseen[1:])
        slope, intercept = platt(margin, *unseen[1:]) if calibrate and len(margin) else (1.0, 0.0)
        return pa.table({
            "model": pa.array([model], pa.int32()), "base": [made.base], "slope": [slope], "intercept": [intercept],
            "feature": pa.array([made.feature.ravel()], pa.list_(pa.int32())), "cut": pa.array([made.cut.ravel()], pa.list_(pa.int32())),
            "leaf": pa.array([made.leaf.ravel()], pa.list_(pa.float64())), "n_train": [int(seen[1].sum())], "n_held": [int(unseen[1].sum())],
            **{k: pa.array([v], pa.float64()) for k, v in report.items()},
        })

    every = counts.withColumn("model", F.explode(F.sequence(F.lit(0), F.lit(models - 1))))
    return every.groupBy("model").applyInArrow(one, _FIT)


class BoostedModel:
    """The mean of one or more ensembles over the same bins."""

    def __init__(self, features: Sequence[str], edges: list[list[float]], depth: int, rows: list):
        """``rows`` is what :func:`fit` returns: trees of fixed size, a row for each ensemble."""
        self.features, self.edges, self.depth = tuple(features), edges, depth
        self.rows = sorted(rows, key=lambda r: r["model"])

    def ensembles(self) -> list[Ensemble]:
        inner = 2**self.depth - 1
        return [
            Ensemble(r["base"], np.array(r["feature"], np.int64).reshape(-1, inner), np.array(r["cut"], np.int64).reshape(-1, inner),
                     np.array(r["leaf"], float).reshape(-1, inner + 1), r["slope"], r["intercept"])
            for r in self.rows
        ]

    def mean(self, metric: str) -> float | None:
        """A held-out metric, averaged over the ensembles that have it."""
        values = [r[metric] for r in self.rows if r[metric] is not None]
        return sum(values) / len(values) if values else None

    def probability(self, spark: SparkSession, cell: str | None = None) -> Column:
        """Probability of the features' columns, or of the column ``cell`` with their bins, with six digits."""
        shared = spark.sparkContext.broadcast((self.edges, self.ensembles()))  # as large as its trees, whatever the rows

        @pandas_udf("double")
        def score(*columns: pd.Series) -> pd.Series:
            edges, ensembles = shared.value
            bins = np.frombuffer(b"".join(columns[0]), np.uint8).reshape(-1, len(edges)) if cell else _matrix(columns, edges)
            bins = bins.astype(np.int64)
            return pd.Series(sum(e.probability(bins) for e in ensembles) / len(ensembles))

        return round_pos(score(*([F.col(cell)] if cell else [F.col(f).cast("double") for f in self.features])), 6)

    def score(self, rows: DataFrame, out: str) -> DataFrame:
        """``rows`` with the probability; missing features have a bin of their own."""
        return rows.withColumn(out, self.probability(rows.sparkSession))

    def save(self, spark: SparkSession, path: str) -> None:
        """One Parquet row for each ensemble, with the bins."""
        schema = f"features array<string>, edges array<array<double>>, depth int, {_FIT}"
        rows = [(list(self.features), self.edges, self.depth, *r) for r in self.rows]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedModel:
        rows = spark.read.parquet(path).collect()  # a row for each ensemble
        fields = [f.split()[0] for f in _FIT.split(", ")]
        first = rows[0]
        return cls(first["features"], [list(e) for e in first["edges"]], first["depth"], [r_only(r, fields) for r in rows])


def r_only(row, fields: Sequence[str]):
    """The row's fields in the order of :func:`fit`."""
    return Row(*fields)(*(row[f] for f in fields))


def train(rows: DataFrame, features: Sequence[str], label: str, part: str, models: int, settings: TreeSettings, calibrate: bool, seed: int) -> BoostedModel:
    """One model for each ``part`` from 0 to ``models - 1``, which learns from the other parts and is measured on its own."""
    edges = bin_edges(rows, features)
    made = fit(cells(rows, features, edges, label, part), models, len(features), settings, calibrate, seed).collect()  # a row per model
    return BoostedModel(features, edges, settings.depth, made)


def train_shared(
    rows: DataFrame, features: Sequence[str], edges: list[list[float]], label: str, held: Column, settings: TreeSettings, seed: int,
    size: int, shard: int = SHARD,
) -> BoostedModel:
    """One model for more rows than a task can hold: it learns from all that are not ``held`` and is measured on those.

    ``rows`` have their :func:`cell` for the given edges; there are about ``size`` of them. Every one counts, as in :func:`train`.
    """
    spark, width, shards = rows.sparkSession, max(map(len, edges)) + 2, max(1, -(-size // shard))
    tasks = min(spark.sparkContext.defaultParallelism, shards)
    seen = rows.where(~held).select("cell", F.col(label).cast("long").alias("y"))
    counts = seen.mapInArrow(_combined, "cell binary, y long, n long").withColumn("shard", F.pmod(F.xxhash64("cell"), F.lit(shards)))
    dealt = counts.repartitionById(tasks, F.expr(f"cast(shard % {tasks} as int)"))
    stored = dealt.mapInArrow(partial(_sharded, features=len(features)), _SHARD)
    grown, learnt = grow_shared(spark, stored, len(features), width, settings, seed)
    fields = [f.split()[0] for f in _FIT.split(", ")]
    trees = [x.ravel().tolist() for x in (grown.feature, grown.cut, grown.leaf)]
    row = Row(*fields)(0, grown.base, 1.0, 0.0, *trees, learnt, 0, None, None, None)
    scored = rows.where(held).select(F.col(label).alias("y"), BoostedModel(features, edges, settings.depth, [row]).probability(spark, "cell").alias("p"))
    report = classifier_metrics(scored, "y", "p").first()
    metrics = {"n_held": report["n_rows"], **{k: report[k] for k in ("auc", "log_loss", "brier_score")}}
    return BoostedModel(features, edges, settings.depth, [Row(*fields)(*({**row.asDict(), **metrics}[k] for k in fields))])
