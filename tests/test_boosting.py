"""Boosted trees held to plain loops."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.operators import boosting
from touchline.operators.boosting import TreeSettings


def plain_split(rows, l2, least):
    """The best (gain, feature, bin) for rows of (bins, gradient, hessian): every feature and bin is tried."""
    best = (0.0, 0, 0)
    whole_g, whole_h = sum(g for _, g, _ in rows), sum(h for *_, h in rows)
    for f in range(len(rows[0][0])):
        for edge in range(6):
            g, h = sum(g for b, g, _ in rows if b[f] <= edge), sum(h for b, _, h in rows if b[f] <= edge)
            if h >= least and whole_h - h >= least:
                gain = g * g / (h + l2) + (whole_g - g) ** 2 / (whole_h - h + l2) - whole_g**2 / (whole_h + l2)
                if gain > best[0] + 1e-9:
                    best = (gain, f, edge)
    return best


@pytest.mark.parametrize("seed", range(8))
def test_best_split(seed):
    rng = np.random.default_rng(seed)
    bins, node = rng.integers(0, 6, (60, 3)), rng.integers(0, 4, 60)
    grad, hess = rng.normal(size=60), rng.uniform(0.05, 0.25, 60)
    sums = np.zeros((2, 4, 3, 6))
    for i in range(60):
        for f in range(3):
            sums[:, node[i], f, bins[i, f]] += (grad[i], hess[i])
    feature, edge, gain = boosting.best_splits(sums[0], sums[1], 1.0, 0.5)
    for k in range(4):
        want = plain_split([(bins[i], grad[i], hess[i]) for i in range(60) if node[i] == k], 1.0, 0.5)
        assert gain[k] == pytest.approx(want[0], abs=1e-9)
        if want[0]:
            assert (feature[k], edge[k]) == want[1:]


def plain_boost(bins, y, settings):
    """Trees over single rows without any sampling, by recursion."""
    share = sum(y) / len(y)
    margin = [math.log(share / (1 - share))] * len(y)

    def descend(rows, depth):
        if depth:
            gain, f, edge = plain_split([(bins[i], grad[i], hess[i]) for i in rows], 1.0, 1.0) if rows else (0, 0, 0)
            if gain:
                descend([i for i in rows if bins[i][f] <= edge], depth - 1)
                descend([i for i in rows if bins[i][f] > edge], depth - 1)
                return
        weight = -settings.rate * sum(grad[i] for i in rows) / (sum(hess[i] for i in rows) + 1.0)
        for i in rows:
            margin[i] += weight

    for _ in range(settings.trees):
        p = [1 / (1 + math.exp(-m)) for m in margin]
        grad, hess = [a - b for a, b in zip(p, y)], [a * (1 - a) for a in p]
        descend(list(range(len(y))), settings.depth)
    return margin


def test_trees_on_cells_equal_trees_on_rows():
    rng = np.random.default_rng(5)
    bins = rng.integers(0, 6, (300, 3))
    y = (rng.uniform(size=300) < 0.15 + 0.6 * (bins[:, 0] > 2) * (bins[:, 1] < 4)).astype(int)
    settings = TreeSettings(trees=6, depth=3, rate=0.3, subsample=1.0, columns=1.0)
    cells, at = np.unique(bins.astype(np.uint8), axis=0, return_inverse=True)
    n, pos = np.bincount(at.ravel()), np.bincount(at.ravel(), y).astype(np.int64)
    made = boosting.grow(cells, n, pos, settings, (1,))
    assert np.allclose(made.margins(bins), plain_boost(bins.tolist(), y.tolist(), settings))


def test_platt_and_metrics():
    rng = np.random.default_rng(3)
    margin = rng.normal(size=4000)
    y = (rng.uniform(size=4000) < 1 / (1 + np.exp(-(2 * margin - 1)))).astype(np.int64)
    slope, intercept = boosting.platt(margin, np.ones(4000, np.int64), y)
    assert abs(slope - 2) < 0.2 and abs(intercept + 1) < 0.15
    p = np.round(boosting.sigmoid(margin[:300]), 1)
    good, bad = p[y[:300] == 1], p[y[:300] == 0]
    want = sum((a > b) + (a == b) / 2 for a in good for b in bad) / (len(good) * len(bad))
    got = boosting.held_out(p, np.ones(300, np.int64), y[:300])
    assert got["auc"] == pytest.approx(want) and got["brier_score"] == pytest.approx(np.mean((p - y[:300]) ** 2))
    assert boosting.held_out(p, np.ones(300, np.int64), np.zeros(300, np.int64))["auc"] is None


def test_bins_and_cells(spark):
    rows = spark.range(1000).select(
        F.when(F.col("id") % 10 != 0, F.col("id").cast("double")).alias("a"), (F.col("id") % 2).alias("b"),
        (F.col("id") % 3 == 0).cast("int").alias("y"), (F.col("id") % 2).alias("part"),
    )
    edges = boosting.bin_edges(rows, ["a", "b"], 11)
    assert len(edges[0]) == 10 and edges[0] == sorted(edges[0])
    assert boosting.binned(np.array([np.nan, -1.0, 1e9]), edges[0]).tolist() == [0, 1, 11]
    counts = boosting.cells(rows, ["a", "b"], edges, "y", "part").collect()
    assert sum(r["n"] for r in counts) == 1000 and sum(r["pos"] for r in counts) == 334
    assert all(len(r["cell"]) == 2 for r in counts) and len(counts) <= 11 * 2 + 2
    empty = boosting.bin_edges(rows.limit(0), ["a", "b"])
    assert empty == [[], []] and boosting.binned(np.array([1.0, np.nan]), []).tolist() == [1, 0]


def test_same_model_whatever_the_partitions(spark):
    rng = np.random.default_rng(1)
    x = rng.uniform(size=(900, 2))
    data = [(float(a), float(b) if b > 0.1 else None, int(rng.uniform() < a), int(i % 3)) for i, (a, b) in enumerate(x)]
    rows = spark.createDataFrame(data, "a double, b double, y int, part int")
    settings = TreeSettings(trees=20, depth=3, rate=0.2)
    models = [boosting.train(r, ["a", "b"], "y", "part", 3, settings, True, 7) for r in (rows.coalesce(1), rows.repartition(5))]
    assert models[0].rows == models[1].rows and models[0].mean("auc") > 0.7
    scored = models[0].score(rows, "p")
    assert scored.filter("p IS NULL OR p <= 0 OR p >= 1").count() == 0
    assert abs(scored.agg(F.avg("p") - F.avg("y")).first()[0]) < 0.03


def test_shared_trees_equal_trees_on_rows(spark):
    """Shards, jobs for levels and sums over tasks lead to the trees of plain loops over all rows, repeated ones included."""
    rng = np.random.default_rng(5)
    bins = rng.integers(0, 6, (300, 3))
    bins = np.concatenate([bins, bins[:40]])
    y = (rng.uniform(size=340) < 0.15 + 0.6 * (bins[:, 0] > 2) * (bins[:, 1] < 4)).astype(int)
    settings = TreeSettings(trees=5, depth=3, rate=0.3, subsample=1.0, columns=1.0)
    names, edges = ["a", "b", "c"], [[float(i) for i in range(6)]] * 3
    data = [(*map(float, b), int(v), i % 5 == 0) for i, (b, v) in enumerate(zip(bins, y))]
    rows = spark.createDataFrame(data, "a double, b double, c double, y int, held boolean").withColumn("cell", boosting.cell(names, edges))
    models = [boosting.train_shared(r, names, edges, "y", F.col("held"), settings, 7, 340, 64) for r in (rows.coalesce(1), rows.repartition(5))]
    assert models[0].rows == models[1].rows
    row, seen = models[0].rows[0], np.arange(340) % 5 != 0
    assert (row["n_train"], row["n_held"]) == (272, 68) and 0.5 < row["auc"] <= 1 and 0 < row["log_loss"] < 1
    want = plain_boost((bins[seen] + 1).tolist(), y[seen].tolist(), settings)
    assert np.allclose(models[0].ensembles()[0].margins(bins[seen] + 1), want, atol=1e-4)


def test_shared_draws_do_not_depend_on_tasks_or_on_written_margins(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 40, (900, 2))
    data = [(float(a), float(b), int(rng.uniform() < a / 40)) for a, b in x]
    edges = [[float(i) for i in range(40)]] * 2
    rows = spark.createDataFrame(data, "a double, b double, y long").select(boosting.cell(["a", "b"], edges).alias("cell"), "y")
    settings, grown = TreeSettings(trees=4, depth=2, rate=0.3), []
    for tasks, every in ((1, 100), (3, 100), (3, 2)):
        counts = rows.groupBy("cell", "y").agg(F.count("*").alias("n")).withColumn("shard", F.pmod(F.xxhash64("cell"), F.lit(6)))
        dealt = counts.repartitionById(tasks, F.expr(f"cast(shard % {tasks} as int)"))
        stored = dealt.mapInArrow(lambda batches: boosting._sharded(batches, 2), boosting._SHARD)
        made, n = boosting.grow_shared(spark, stored, 2, 42, settings, 7, every)
        assert n == 900
        grown.append((made.base, made.feature.tolist(), made.cut.tolist(), made.leaf.tolist()))
    assert grown[0] == grown[1] == grown[2] and any(c != boosting.ALL_LEFT for c in np.ravel(grown[0][2]))
