"""Operators against brute force and hand-made cases."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.functions import coordinates as xy
from touchline.functions.labels import fixed
from touchline.functions.numeric import exact_avg, exact_sum, round_any, round_pos
from touchline.operators import classifiers, kmeans, metrics, quality, running, sequences, similarity, xt, zones
from touchline.plans import features, reports, silver
from touchline.plans.marts import opponent_passes


def one(df):
    (row,) = df.collect()
    return row[0] if len(row) == 1 else row


def value(spark, column):
    return one(spark.range(1).select(column))


# --- numbers ----------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "x, digits, expected",
    [(0.2625, 3, 0.263), (0.3 * 0.875, 3, 0.263), (1.005, 2, 1.01), (2.5, 0, 3.0), (-1.005, 2, -1.01), (-0.00001, 2, 0.0),
     (52.0625, 3, 52.063), (0.0, 4, 0.0)],
)
def test_rounding_is_half_away_from_zero(spark, x, digits, expected):
    got = value(spark, round_any(F.lit(x), digits))
    assert got == expected and math.copysign(1, got) == math.copysign(1, expected)
    if x >= 0:
        assert value(spark, round_pos(F.lit(x), digits)) == expected


def test_exact_sum_does_not_depend_on_partitioning(spark):
    random.seed(1)
    data = [(round(random.uniform(-0.1, 0.3), 6),) for _ in range(5000)]
    df = spark.createDataFrame(data, "v double")
    sums = {one(df.repartition(n).agg(exact_sum(F.col("v"), 6))) for n in (1, 3, 7)}
    assert len(sums) == 1 and abs(sums.pop() - math.fsum(v for (v,) in data)) < 1e-9
    assert one(df.where("false").agg(exact_avg(F.col("v"), 6))) is None


def test_bundle_places_cells_by_the_stored_value(spark):
    surface = spark.createDataFrame([(0, 0, 0.123401), (1, 0, 0.123449), (2, 0, 0.1)], "grid_col int, grid_row int, xt_value double")
    fact = spark.createDataFrame([("e", 0.1)], "event_id string, xt_value double")
    ledger = spark.createDataFrame([("success", 1, 5)], "status string, competition_id int, event_count long")
    rows = reports.verify_bundle(surface, fact, None, ledger).where("section = 'cell'").orderBy("place").collect()
    assert [(r["item"], r["value"]) for r in rows] == [("1,0", 0.1234), ("0,0", 0.1234), ("2,0", 0.1)]


# --- coordinates ------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "system, x, y, ex, ey",
    [("statsbomb_120x80", 126.0, 84.0, 105.0, 68.0), ("opta_100x100", 110.0, 105.0, 105.0, 68.0),
     ("statsbomb_120x80", -10.0, -5.0, 0.0, 0.0), ("wyscout_100x100", 50.0, 50.0, 52.5, 34.0),
     ("other", 33.0, 21.0, 33.0, 21.0)],
)
def test_normalised_and_clamped(spark, system, x, y, ex, ey):
    s = F.lit(system)
    gx = value(spark, xy.clamp(xy.normalise_x(F.lit(x), s), 0.0, 105.0))
    gy = value(spark, xy.clamp(xy.normalise_y(F.lit(y), s), 0.0, 68.0))
    assert (gx, gy) == (ex, ey)


def test_clamp_of_a_missing_value(spark):
    missing = F.lit(None).cast("double")
    assert value(spark, xy.clamp(missing, 0.0, 105.0)) == 0.0
    assert value(spark, xy.clamp(missing, 0.0, 105.0, null_safe=True)) is None


@pytest.mark.parametrize("x, y, cell", [(0, 0, 0), (105, 68, 191), (200, 200, 191), (6.6, 0, 1), (0, 5.7, 16), (52.5, 34, 104)])
def test_grid_cell(spark, x, y, cell):
    assert value(spark, xy.grid_cell(F.lit(float(x)), F.lit(float(y)))) == cell


# --- expected threat --------------------------------------------------------------------------------------


def actions(spark, rows):
    schema = "event_id string, event_type string, location_x double, location_y double, end_location_x double, end_location_y double, outcome string"
    return xt.xt_actions(spark.createDataFrame(rows, schema))


SAMPLE = [
    ("a", "Carry", 47.5, 12.25, 71.0, 9.5, ""), ("b", "Shot", 92.0, 27.5, None, None, "Goal"),
    ("c", "Pass", 71.0, 9.5, 92.0, 27.5, "Unknown"), ("d", "Pass", 47.5, 12.25, 13.0, 55.0, None),
    ("e", "Shot", 92.0, 28.0, None, None, "Off T"), ("f", "Pass", 71.0, 9.5, 72.0, 9.0, "Incomplete"),
    ("g", "Interception", 3.0, 66.0, None, None, None), ("h", "Pass", 92.0, 27.5, None, None, None),
]


def test_hot_cell_without_moves(spark):
    # With no moves the value is the share of shots times the share of goals among them.
    kind = "cell int, shot_prob double, goal_prob double, moves array<struct<dst:int,n:bigint>>, n_moves bigint"
    cells = spark.createDataFrame([(57, 0.25, 0.5, [], 0)], kind)
    surface = {r.cell: r.xt for r in xt.solve_cells(cells).collect()}
    assert len(surface) == 192 and surface[57] == pytest.approx(0.125)
    assert all(v == 0 for k, v in surface.items() if k != 57)


def brute_surface(rows, iterations=10):
    def cell(x, y):
        return min(int(y / (68 / 12)), 11) * 16 + min(int(x / (105 / 16)), 15)

    n = 192
    act, shots, goals, move = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros((n, n))
    for _, kind, x, y, ex, ey, out in rows:
        if kind not in ("Pass", "Carry", "Shot"):
            continue
        a = cell(x, y)
        act[a] += 1
        if kind == "Shot":
            shots[a] += 1
            goals[a] += out == "Goal"
        elif out in (None, "Unknown", "") and ex is not None:
            move[a, cell(ex, ey)] += 1
    s = np.divide(shots, act, out=np.zeros(n), where=act > 0)
    g = np.divide(goals, shots, out=np.zeros(n), where=shots > 0)
    tot = move.sum(axis=1, keepdims=True)
    t = np.divide(move, tot, out=np.zeros((n, n)), where=tot > 0)
    v = np.zeros(n)
    for _ in range(iterations):
        v = s * g + (1 - s) * (t @ v)
    return v


def test_surface_equals_matrix_iteration(spark):
    random.seed(3)
    rows = list(SAMPLE)
    for i in range(800):
        kind = random.choice(["Pass", "Carry", "Shot"])
        end = (random.uniform(0, 105), random.uniform(0, 68)) if kind != "Shot" else (None, None)
        rows.append((f"r{i}", kind, random.uniform(0, 105), random.uniform(0, 68), *end, random.choice(["Goal", None, "Unknown", "x"])))
    edges = xt.cell_edges(actions(spark, rows))
    got = {r.cell: r.xt for r in xt.xt_surface(edges).collect()}
    assert np.allclose([got[i] for i in range(192)], brute_surface(rows), atol=1e-12)
    sums = xt.transitions(edges).groupBy("src").agg(F.sum("p").alias("s")).collect()
    assert all(r.s == pytest.approx(1.0) for r in sums)


def test_no_shots_give_a_zero_surface(spark):
    surface = xt.xt_surface(xt.cell_edges(actions(spark, [r for r in SAMPLE if r[1] != "Shot"])))
    assert {r.xt for r in surface.collect()} == {0.0}
    assert {r.xt for r in xt.xt_surface(xt.cell_edges(actions(spark, SAMPLE[6:7]))).collect()} == {0.0}


def test_event_values(spark):
    acts = actions(spark, SAMPLE)
    surface = xt.xt_surface(xt.cell_edges(acts))
    by_cell = {r.cell: r.xt for r in surface.collect()}
    cells = {r.event_id: (r.cell, r.end_cell) for r in acts.collect()}
    got = {r.event_id: r.xt_value for r in xt.event_xt(acts, surface).select("event_id", "xt_value").collect()}
    assert set(got) == {"a", "b", "c", "d", "e"}
    assert got["b"] == pytest.approx(by_cell[cells["b"][0]], abs=1e-6)
    assert got["c"] == pytest.approx(by_cell[cells["c"][1]] - by_cell[cells["c"][0]], abs=1e-6)


# --- press triggers ---------------------------------------------------------------------------------------

PRESS = "event_id string, match_id int, team_id int, event_type string, minute int, second int"


def press(spark, rows):
    df = spark.createDataFrame([(f"e{i}", 1, 1, kind, t // 60, t % 60) for i, (kind, t) in enumerate(rows)], PRESS)
    return sorted(r.event_id for r in sequences.press_triggers(df).collect())


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([("Ball Recovery", 100), ("Pressure", 100), ("Tackle", 102), ("Block", 104)], ["e1", "e2", "e3"]),
        ([("Ball Recovery", 100), ("Pressure", 100), ("Tackle", 102)], []),
        ([("Ball Recovery", 100), ("Pressure", 101), ("Tackle", 102), ("Block", 105)], ["e1", "e2", "e3"]),
        ([("Ball Recovery", 100), ("Pressure", 101), ("Tackle", 102), ("Block", 106)], []),
        ([("Ball Recovery", 77), ("Pressure", 83), ("Pressure", 91), ("Pressure", 140)], []),
        ([("Pressure", 100), ("Pressure", 100), ("Pressure", 100)], []),
        ([("Pressure", 100), ("Pressure", 100), ("Pressure", 100), ("Ball Recovery", 100)], ["e0", "e1", "e2"]),
        ([], []),
    ],
)
def test_press_trigger_cases(spark, rows, expected):
    assert press(spark, rows) == expected


def test_press_triggers_equal_brute_force(spark):
    random.seed(5)
    kinds = ["Ball Recovery", "Pressure", "Tackle", "Block", "Interception", "Pass"]
    rows = [
        (f"e{i}", random.randint(1, 3), random.choice([1, 2, None]), random.choice(kinds), random.randint(0, 4),
         random.choice([None, *range(60)])) for i in range(1500)
    ]
    want = set()
    clock = {r[0]: r[4] * 60 + (r[5] or 0) for r in rows}
    for rec in (r for r in rows if r[3] == "Ball Recovery" and r[2] is not None):
        near = [a[0] for a in rows if a[1:3] == rec[1:3] and a[3] in sequences.PRESS_TYPES
                and clock[rec[0]] <= clock[a[0]] <= clock[rec[0]] + 5]
        if len(near) >= 3:
            want.update(near)
    got = [r.event_id for r in sequences.press_triggers(spark.createDataFrame(rows, PRESS)).collect()]
    assert set(got) == want and len(got) == len(want) and want


# --- running sums, ranks, windows -------------------------------------------------------------------------


def test_running_sum_with_one_partition_holding_most_rows(spark):
    random.seed(7)
    rows = [("hot" if random.random() < 0.8 else random.choice("ab") if random.random() < 0.9 else None, i, random.randint(-5, 9))
            for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, id int, v long")
    got = {r.id: r.s for r in running.running_sum(df, ["k"], [F.col("id").asc()], F.col("v"), "s", ranges=7).collect()}
    sums, want = defaultdict(int), {}
    for k, i, v in rows:
        sums[k] += v
        want[i] = sums[k]
    assert got == want


def test_rank_shares_ties_and_puts_nulls_first(spark):
    rows = [("a", 5), ("a", 5), ("a", 9), ("a", None), ("a", 1), ("b", 2)] + [("c", i // 3) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, v long")
    got = sorted((r.k, r.v if r.v is not None else -1, r.r) for r in running.rank_rows(df, ["k"], "v", "r").collect())
    frame = df.toPandas()
    want = []
    for key, group in frame.groupby("k"):
        vals = [math.inf if np.isnan(v) else v for v in group["v"]]
        want += [(key, -1 if v == math.inf else int(v), 1 + sum(o > v for o in vals)) for v in vals]
    assert got == sorted(want)


def test_requests_across_block_edges(spark):
    random.seed(9)
    rows = [(random.choice([1, 1, 1, 2]), random.randint(0, 5000)) for _ in range(1500)]
    df = spark.createDataFrame(rows, "user int, t long").withColumn("ts", F.timestamp_seconds("t"))
    got = {(r.user, r.sec): r.attempts_in_window for r in sequences.requests_per_key(df, "user", "ts", 10, 7).collect()}
    want = {(u, t): sum(1 for v, s in rows if v == u and t - 7 <= s <= t) for u, t in set(rows)}
    assert got == want


# --- neighbours -------------------------------------------------------------------------------------------


def brute_neighbours(vectors, n):
    ids = sorted(vectors)
    mat = np.array([vectors[i] for i in ids], dtype=float)
    length = np.sqrt((mat * mat).sum(axis=1, keepdims=True))
    unit = np.divide(mat, length, out=np.zeros_like(mat), where=length > 0)
    scores = np.array([[float(f"{abs(s):.8f}") * (1 if s >= 0 else -1) for s in row] for row in unit @ unit.T])
    scores = np.sign(scores) * np.floor(np.round(np.abs(scores) * 1e8) / 100 + 0.5) / 1e6
    out = {}
    for i, row in zip(ids, scores):
        order = sorted(((-s, j) for s, j in zip(row, ids) if j != i))[:n]
        out[i] = [(j, max(0.0, -s)) for s, j in order]
    return out


@pytest.mark.parametrize("shape", ["random", "clustered", "copies", "zeros", "few"])
def test_neighbours_equal_brute_force(spark, shape):
    rng = np.random.default_rng(11)
    count = 4 if shape == "few" else 400
    mat = rng.normal(size=(count, 5))
    if shape == "clustered":
        mat = rng.normal(size=(8, 5))[rng.integers(0, 8, count)] + rng.normal(scale=0.02, size=(count, 5))
    if shape == "copies":
        mat[50:200] = mat[0]
        mat[200:230] = mat[1] * 3
    if shape == "zeros":
        mat[::3] = 0
    vectors = {int(i): [float(v) for v in row] for i, row in zip(rng.permutation(5 * count)[:count], mat)}
    df = spark.createDataFrame(list(vectors.items()), "pid int, vec array<double>")
    got = defaultdict(list)
    result = similarity.cosine_neighbours(df, "pid", n=5, block_rows=32, pivots=16)
    for r in sorted(result.collect(), key=lambda r: r["rank"]):
        got[r.pid].append((r.similar_pid, r.similarity_score))
    want = brute_neighbours(vectors, 5)
    assert set(got) == set(want)
    for key, expected in want.items():
        assert [i for i, _ in got[key]] == [i for i, _ in expected]
        assert np.allclose([s for _, s in got[key]], [s for _, s in expected], atol=1e-9)


@pytest.mark.parametrize("clustered", [False, True])
def test_neighbours_across_strips_equal_brute_force(spark, monkeypatch, clustered):
    rng = np.random.default_rng(5)
    mat = rng.normal(size=(600, 6))
    if clustered:
        mat = rng.normal(size=(12, 6))[rng.integers(0, 12, 600)] + rng.normal(scale=0.02, size=(600, 6))
    monkeypatch.setattr(similarity, "STRIP_VALUES", 6 * 90)  # seven strips
    monkeypatch.setattr(similarity, "CHUNK_ROWS", 20)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(mat)], "pid long, vec array<double>")
    got = defaultdict(list)
    for r in sorted(similarity.cosine_neighbours(df, "pid", n=5, block_rows=16).collect(), key=lambda r: r["rank"]):
        got[r.pid].append((r.similar_pid, r.similarity_score))
    want = brute_neighbours(dict(enumerate(mat)), 5)
    assert {k: [i for i, _ in v] for k, v in got.items()} == {k: [i for i, _ in v] for k, v in want.items()}
    assert all(np.allclose([x for _, x in got[k]], [x for _, x in v], atol=1e-9) for k, v in want.items())


def test_search_sends_a_row_once_per_strip(spark, monkeypatch):
    """Fine blocks prune, but they do not multiply the rows that travel: the rows of both sides are counted in the tasks."""
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(800, 8)))], "id long, vec array<double>")
    df = df.select("id", similarity.unit(F.col("vec")).alias("vec"))
    sent = spark.sparkContext.accumulator(0)

    def run(function):
        def task(left, right):
            sent.add(len(left) + len(right))
            return function(left, right)

        return task

    kind = type(df.groupBy("id").cogroup(df.groupBy("id")))
    apply = kind.applyInPandas
    monkeypatch.setattr(kind, "applyInPandas", lambda self, function, schema: apply(self, run(function), schema))
    assert similarity._search(df, 5, 20, 4096).count() == 5 * 800
    assert sent.value <= 800 * (1 + 2 * spark.sparkContext.defaultParallelism)


def test_approximate_neighbours_of_a_large_group(spark):
    """Near copies beyond the size of a bucket meet all the same; every row has its neighbours, with a recall of 0.9."""
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=(1, 8)) + 0.01 * rng.normal(size=(500, 8)), rng.normal(size=(150, 8)), np.zeros((1, 8))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "pid long, vec array<double>")
    got = similarity.approximate_neighbours(df, "pid", n=5, bucket_rows=20).collect()
    want = {(r.pid, r.similar_pid) for r in similarity.cosine_neighbours(df, "pid", n=5).collect()}
    found = {(r.pid, r.similar_pid) for r in got}
    assert len(got) == len(found) == 5 * len(x)
    assert len(found & want) >= 0.9 * len(want) and {r.recall >= 0.9 for r in got} == {True}


def test_tables_are_not_added_beyond_what_the_exact_search_sends(spark, monkeypatch):
    """Vectors that point everywhere: tables that cannot reach the recall in time are not built."""
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(1000, 24)))], "pid long, vec array<double>")
    built, plain = [], similarity._in_buckets
    monkeypatch.setattr(similarity, "_in_buckets", lambda reps, total, k, tables, *rest: built.append(tables) or plain(reps, total, k, tables, *rest))
    got = similarity.approximate_neighbours(df, "pid", n=5, tables=2, bucket_rows=8)
    want = {(r.pid, r.similar_pid) for r in similarity.cosine_neighbours(df, "pid", n=5).collect()}
    assert {(r.pid, r.similar_pid) for r in got.collect()} == want and built == [2]
    assert similarity.tables_for(0.9, 0.9, 12) == pytest.approx(12) and similarity.tables_for(0.75, 0.5, 3) == pytest.approx(6)


def test_scaling_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 3.0, 5.0), (3, None, 5.0)], "player_id int, a double, b double")
    got = {r.player_id: r.vec for r in similarity.standardised(df, "player_id", ["a", "b"]).collect()}
    a = np.array([1.0, 3.0, 0.0])
    assert np.allclose([got[i][0] for i in (1, 2, 3)], (a - a.mean()) / a.std())
    assert {v[1] for v in got.values()} == {0.0}


# --- metrics, features, zones -----------------------------------------------------------------------------


def test_classifier_metrics_equal_pairwise_definition(spark):
    random.seed(13)
    rows = [(random.randint(0, 1), random.choice([0.1, 0.25, 0.5, 0.123456, 0.9])) for _ in range(300)]
    got = metrics.classifier_metrics(spark.createDataFrame(rows, "y int, p double"), "y", "p").first()
    pos, neg = [p for y, p in rows if y], [p for y, p in rows if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    loss = -sum(math.log(p if y else 1 - p) for y, p in rows) / len(rows)
    assert got.auc == pytest.approx(auc, abs=6e-5) and got.log_loss == pytest.approx(loss, abs=6e-5)
    assert got.brier_score == pytest.approx(sum((p - y) ** 2 for y, p in rows) / len(rows), abs=6e-5)
    assert got.actual_positives == len(pos) and got.n_rows == 300


PASS = "event_id string, location_x double, location_y double, end_location_x double, end_location_y double, outcome string, under_pressure boolean, minute int"


def test_xp_features(spark):
    rows = [
        ("goalwards", 50.0, 34.0, 60.0, 34.0, "Unknown", False, 45), ("backwards", 50.0, 34.0, 40.0, 34.0, "x", True, 46),
        ("still", 50.0, 34.0, 50.0, 34.0, "Unknown", False, 91), ("from goal", 105.0, 34.0, 50.0, 34.0, "Unknown", False, 0),
    ]
    got = {r.event_id: r for r in features.xp_features(spark.createDataFrame(rows, PASS)).collect()}
    assert got["goalwards"].angle_to_goal == pytest.approx(0) and got["backwards"].angle_to_goal == pytest.approx(math.pi)
    assert got["still"].angle_to_goal == 0 and got["from goal"].angle_to_goal == 0
    assert [got[k].minute_bin for k in ("goalwards", "backwards", "still")] == [0, 1, 2]
    assert [got[k].target for k in ("goalwards", "backwards")] == [1, 0]
    assert got["goalwards"].distance == pytest.approx(10 / 105)


def test_minutes_outside_the_match_are_an_error(spark):
    bad = spark.createDataFrame([("x", 1.0, 1.0, 2.0, 2.0, None, False, -5)], PASS)
    with pytest.raises(Exception, match="minute outside"):
        features.xp_features(bad).collect()


POINTS = "event_id string, event_type string, location_x double, location_y double"


def test_zones(spark):
    rng = np.random.default_rng(17)
    spots = [(0.5, 0.5), (104.5, 0.5), (0.5, 67.5), (104.5, 67.5), (0.5, 34.0), (104.5, 34.0)]
    corners = [(f"c{i}", "Corner", spots[i % 6][0] + rng.uniform(-0.4, 0.4), spots[i % 6][1] + rng.uniform(-0.4, 0.4)) for i in range(60)]
    few = [(f"s{i}", "Shot", 90.0 + i, 30.0) for i in range(5)]
    got = zones.kmeans_zones(spark.createDataFrame(corners + few, POINTS), restarts=4).collect()
    assert {r.event_type for r in got} == {"Corner"} and sorted(r.cluster_label for r in got) == list(range(6))
    assert sorted(r.member_count for r in got) == [10] * 6
    assert sorted((round(r.center_x / 105, 1), round(r.center_y / 68, 1)) for r in got) == sorted(
        (round(x / 105, 1), round(y / 68, 1)) for x, y in spots
    )


def test_zones_of_equal_points(spark):
    same = spark.createDataFrame([(f"s{i}", "Shot", 90.0, 30.0) for i in range(12)], POINTS)
    got = zones.kmeans_zones(same, restarts=1).collect()
    assert sum(r.member_count for r in got) == 12 and {(r.center_x, r.center_y) for r in got if r.member_count} == {(90.0, 30.0)}
    assert zones.kmeans_zones(same.where("false")).count() == 0


@pytest.fixture(scope="module")
def two_groups(spark):
    """Weighted places of two groups on the grid of the fits, over several partitions."""
    rng = np.random.default_rng(3)
    spots = {"a": rng.normal(size=(7, 2)) * 3, "b": rng.normal(size=(5, 2))}
    rows = {
        (name, *map(int, kmeans.on_grid(there[rng.integers(len(there))] + rng.normal(size=2) * 0.1))): int(rng.integers(1, 4))
        for name, there in spots.items() for _ in range(400)
    }
    rows = [(*place, weight) for place, weight in rows.items()]
    return rows, spark.createDataFrame(rows, "grp string, x bigint, y bigint, weight bigint").repartition(5)


def test_kmeans_cells_hold_every_point(two_groups):
    rows, points = two_groups
    cells = kmeans.cells_of(points, ("x", "y")).collect()
    for name in "ab":
        own, got = [r for r in rows if r[0] == name], [r for r in cells if r.grp == name]
        assert sum(r.n for r in got) == sum(r[3] for r in own)
        assert sum(r.x for r in got) == sum(r[1] * r[3] for r in own) and sum(r.y for r in got) == sum(r[2] * r[3] for r in own)
        assert len(got) <= kmeans.COARSE**2


def test_kmeans_equals_plain_steps(two_groups):
    rows, points = two_groups
    fits = kmeans.fit(points, ("x", "y"), 4, 3, 300, 0.0, 11)
    assert set(fits) == {"a", "b"}
    for name, fit in fits.items():
        own = np.array([r[1:] for r in rows if r[0] == name], dtype="float64")
        at, weight = own[:, :2] / kmeans.UNIT, own[:, 2]
        away = ((at[:, None] - fit.centres[None]) ** 2).sum(axis=2)
        label = away.argmin(axis=1)
        assert fit.members.tolist() == np.bincount(label, weight, 4).tolist() and fit.members.sum() == weight.sum()
        for j, centre in enumerate(fit.centres):  # a centre that rests is the mean of its points
            assert np.allclose(centre, np.average(at[label == j], axis=0, weights=weight[label == j]), atol=1e-9)
        assert fit.cost == pytest.approx((away.min(axis=1) * weight).sum(), rel=1e-4)
        # No worse than the best of as many plain fits over the rows, within what a local minimum may differ.
        plain = []
        for r in range(3):
            centres = kmeans.fit_cells(at, weight, 4, 300, 0.0, np.random.default_rng([11, r, *name.encode()]))
            plain.append((((at[:, None] - centres[None]) ** 2).sum(axis=2).min(axis=1) * weight).sum())
        assert fit.cost <= 1.25 * min(plain)


def test_kmeans_does_not_depend_on_partitions(two_groups):
    _, points = two_groups
    first, second = (kmeans.fit(df, ("x", "y"), 3, 2, 300, 1e-4, 5) for df in (points, points.repartition(2, "x")))
    for name, fit in first.items():
        assert np.array_equal(fit.centres, second[name].centres) and fit.cost == second[name].cost


def test_kmeans_of_nothing(two_groups):
    _, points = two_groups
    assert kmeans.fit(points.where("false"), ("x", "y"), 3, 2, 300, 1e-4, 5) == {}


def test_opponent_passes_equal_the_theta_join(spark):
    random.seed(19)
    kinds = ["Pass", "Tackle", "Foul", "Block", "Carry"]
    rows = [(f"e{i}", random.randint(1, 4), random.choice([1, 2, 3, None]), random.choice(kinds), 1.0) for i in range(400)]
    df = spark.createDataFrame(rows, "event_id string, match_id int, team_id int, event_type string, end_location_x double")
    got = {(r.match_id, r.team_id): (r.defensive_actions, r.passes_allowed) for r in opponent_passes(df).collect()}
    want = {}
    for m in range(1, 5):
        for t in range(1, 4):
            acts = sum(1 for r in rows if r[1] == m and r[2] == t and r[3] in ("Tackle", "Foul", "Block"))
            if acts:
                want[m, t] = (acts, sum(1 for r in rows if r[1] == m and r[2] not in (t, None) and r[3] == "Pass"))
    assert got == want


# --- models -----------------------------------------------------------------------------------------------

SHOT = "event_id string, distance_to_goal double, shot_angle double, under_pressure int, is_header int, body_part string, is_goal int"


def shots(spark, n=240, goals=True):
    rng = np.random.default_rng(23)
    rows = []
    for i in range(n):
        d = float(rng.uniform(5, 40))
        goal = int(goals and rng.random() < 1 / (1 + math.exp((d - 14) / 4)))
        rows.append((f"s{i}", d, float(rng.uniform(0.1, 1.5)), int(rng.integers(2)), int(rng.integers(2)), ["Head", "Left Foot"][i % 2], goal))
    return features.xg_features(spark.createDataFrame(rows, SHOT))


def test_body_parts_are_numbered_alphabetically(spark):
    got = {(r.body_part, r.body_part_encoded) for r in shots(spark, 10).collect()}
    assert got == {("Head", 0), ("Left Foot", 1)}


def test_xg_model(spark, tmp_path):
    data = shots(spark)
    quick = classifiers.TreeSettings(trees=5, depth=3, rate=0.3)
    model, report = classifiers.train_xg(data, quick, max_folds=2)
    assert report["roc_auc"] > 0.55 and report["total_shots"] == 240
    assert abs(report["expected_goals"] - report["actual_goals"]) < 0.25 * report["actual_goals"]
    scored = {r.event_id: r.xg_value for r in classifiers.score_xg(model, data).collect()}
    assert len(scored) == 240 and all(0 <= v <= 1 for v in scored.values())
    assert report["holdout_auc"] > 0.5 and len(model.rows) == 2 and sum(r["n_held"] for r in model.rows) == 240
    classifiers.save_model(spark, model, str(tmp_path / "xg"))
    loaded = classifiers.load_model(spark, str(tmp_path / "xg"))
    assert {r.event_id: r.xg_value for r in classifiers.score_xg(loaded, data).collect()} == scored


def test_xg_guards(spark):
    with pytest.raises(classifiers.TrainingError, match="no shots"):
        classifiers.train_xg(shots(spark).where("false"))
    with pytest.raises(classifiers.TrainingError, match="no goals"):
        classifiers.train_xg(shots(spark, 120, goals=False))


def test_xp_model(spark, tmp_path):
    rng = np.random.default_rng(29)
    rows = []
    for i in range(800):
        x, y, ex, ey = rng.uniform(0, 105), rng.uniform(0, 68), rng.uniform(0, 105), rng.uniform(0, 68)
        rows.append((f"p{i}", float(x), float(y), float(ex), float(ey), "Unknown" if abs(ex - x) < 20 else "Out", False, int(rng.integers(90))))
    data = features.xp_features(spark.createDataFrame(rows, PASS))
    model, report = classifiers.train_xp(data, classifiers.TreeSettings(trees=5, depth=4, rate=0.3))
    assert report["auc"] > 0.8 and 550 < report["train_size"] < 730
    scored = classifiers.score_xp(model, data)
    assert scored.count() == 800
    some = scored.where(F.col("xp_value") > 0.5)
    assert classifiers.score_xp(model, data, scored=some).count() == 800 - some.count()
    assert classifiers.needs_xp(data, some) and not classifiers.needs_xp(data, scored)
    classifiers.save_model(spark, model, str(tmp_path / "xp"))
    again = classifiers.load_model(spark, str(tmp_path / "xp"))
    assert classifiers.score_xp(again, data).exceptAll(scored).count() == 0
    assert classifiers.train_xp(data.limit(100)) == (None, {})


def test_xp_learns_from_every_pass(spark):
    """Beyond the size of the published sample, too."""
    n = 301_000
    where = [(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(500)) / 500).alias(name) for i, name in enumerate(features.XP_FEATURES)]
    passes = spark.range(n).select(F.col("id").cast("string").alias("event_id"), *where)
    passes = passes.withColumn("target", F.when(F.col("distance") < 0.3, 1).otherwise(0))
    model, report = classifiers.train_xp(passes, classifiers.TreeSettings(trees=2, depth=2, rate=0.3, columns=1.0))
    positives = passes.where("target = 1").count()
    assert report["test_size"] == positives // 5 + (n - positives) // 5 and report["train_size"] == n - report["test_size"]
    assert report["auc"] > 0.99 and model.rows[0]["n_train"] == report["train_size"]


def test_split_and_sample(spark):
    rows = spark.range(20000).select(F.col("id").cast("string").alias("event_id"), (F.col("id") % 4 == 0).cast("int").alias("y"))
    train, test = classifiers.stratified_split(rows, "y")
    assert train.count() + test.count() == 20000 and train.join(test, "event_id").count() == 0
    share = test.groupBy("y").count().collect()
    assert {r.y: round(r["count"] / (5000 if r.y else 15000), 1) for r in share} == {0: 0.2, 1: 0.2}
    assert abs(classifiers.training_sample(rows, 5000).count() - 5000) < 300
    assert classifiers.training_sample(rows, 30000).count() == 20000


# --- quality ----------------------------------------------------------------------------------------------


def test_gate(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 200.0), (None, 3.0)], "event_id string, location_x double")
    found = quality.tally(df, {"id": F.col("event_id").isNull(), "range": quality.outside("location_x", 0, 105)})
    assert {r.check: r.failing for r in found.collect()} == {"id": 1, "range": 1}
    assert quality.check_unique(df, "event_id").first().n_records == 2
    assert quality.check_range(df, "location_x", 1, 200, inclusive=False).count() == 2
    assert quality.check_accepted_values(df, "event_id", ["b"]).count() == 2
    with pytest.raises(quality.GateError, match="silver checks failed"):
        quality.gate("silver", found)
    quality.gate("silver", found.where("false"))


def test_wide_values_are_unique_by_digest(spark, tmp_path):
    rows = [(i, f"payload {i % 900}" * 20 if i % 10 else None) for i in range(1000)] + [(1000, ""), (1001, "")]
    path = str(tmp_path / "t")
    spark.createDataFrame(rows, "id int, body string").write.parquet(path)
    df = spark.read.parquet(path)
    narrow, wide = quality.check_unique(df, "body"), quality.check_unique(df, "body", wide=True)
    assert sorted(narrow.collect()) == sorted(wide.collect()) and wide.count() == 91
    assert quality.check_unique(df.where("id < 5"), "body", wide=True).count() == 0
    # Payloads are narrowed by the digests before the only exchange that carries them.
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan.index("Exchange hashpartitioning(body") < plan.index("BroadcastHashJoin")


def test_many_repeated_payloads_are_added_up_before_they_move(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.createDataFrame([(f"payload {i % 300}" * 20,) for i in range(900)] + [("once",), (None,)], "body string").write.parquet(path)
    df = spark.read.parquet(path)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the digests were many
    try:
        monkeypatch.setattr(quality, "FEW_DIGESTS", 10, raising=False)
        wide = quality.check_unique(df, "body", wide=True)
        assert sorted(wide.collect()) == sorted(quality.check_unique(df, "body").collect()) and wide.count() == 300
        plan = wide._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "Sort [" not in plan
        # The one exchange has a partial count on either side of it, and no row of the table goes through it by itself.
        assert plan.rindex("partial_count") > plan.index("Exchange hashpartitioning(body") and "hashpartitioning(_digest" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


RAW = "event_id string, provider string, raw_json string, event_type string, match_id int, team_id int, player_id int, minute int, second int, location_x double, location_y double, outcome string, under_pressure boolean"


@pytest.mark.parametrize(
    "provider, payload, header, part",
    [
        ("statsbomb", '{"shot":{"technique":{"name":"Header"},"body_part":{"name":"Head"}}}', True, "Head"),
        ("statsbomb", '{"shot":{"technique":{"name":"Volley"}}}', False, "Unknown"),
        ("opta", '{"Qualifiers":[{"QualifierId":15},{"QualifierId":72,"Value":"x"}]}', True, "Unknown"),
        ("opta", '{"Qualifiers":[{"QualifierId":15}]}', False, "Unknown"),
        ("wyscout", '{"shot":{"technique":{"name":"Header"}}}', False, "Unknown"),
        ("opta", None, False, "Unknown"), ("statsbomb", None, False, "Unknown"),
    ],
)
def test_shot_payload(spark, provider, payload, header, part):
    row = ("e", provider, payload, "Shot", 1, 1, 1, 1, 1, 94.0, 34.0, "Goal", False)
    got = silver.silver_shots(spark.createDataFrame([row], RAW)).first()
    assert (got.is_header, got.body_part, got.is_goal, got.distance_to_goal) == (header, part, 1, 11.0)
    assert got.shot_angle == pytest.approx(abs(math.atan2(7.32 * 11, 121 - 3.66**2)), abs=1e-5)


# --- arithmetic at size -----------------------------------------------------------------------------------


def test_rounding_of_large_totals(spark):
    values = [1e11, 1e13 + 0.125, -2.5e13, 9.3e10 + 0.00005, 3e15, 1e300, 0.00005, -0.00005]
    got = [r.v for r in spark.createDataFrame([(v,) for v in values], "x double").select(round_any(F.col("x"), 4).alias("v")).collect()]
    assert got == [1e11, 1e13 + 0.125, -2.5e13, 9.3e10 + 0.0001, 3e15, 1e300, 0.0001, -0.0001]


def test_fixed_prints_as_printf(spark):
    random.seed(5)
    values = [i / 10000 + 0.0005 for i in range(0, 10000, 7)] + [0.0045, 30.25, 30.75, 0.5, -0.0045, -30.25, 1e9 + 0.125, 0.0]
    values += [random.uniform(-1000, 1000) for _ in range(500)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    got = df.select("i", "x", *[fixed(F.col("x"), d).alias(f"d{d}") for d in (1, 2, 3, 4)]).collect()
    for r in got:
        for d in (1, 2, 3, 4):
            assert r[f"d{d}"] == f"{r.x:.{d}f}", (r.x, d)


def test_metrics_of_billions_of_pairs(spark):
    rows = spark.createDataFrame([(0.2, 0, 5 * 10**9), (0.8, 5 * 10**9, 0)], "p double, pos bigint, neg bigint")
    rows = rows.withColumn("n", F.col("pos") + F.col("neg"))
    below = F.when(F.col("p") > 0.5, F.lit(5 * 10**9)).otherwise(F.lit(0).cast("bigint"))
    zero = F.lit(0.0)
    assert metrics._summary(rows, below, F.sum("n") * 0.5, zero, zero).first()["auc"] == 1.0


def test_exact_metrics_keep_close_scores_apart(spark):
    rows = spark.createDataFrame([(1, 0.5000002), (0, 0.5000001)] * 3, "y int, p double")
    assert metrics.classifier_metrics(rows, "y", "p").first()["auc"] == 0.5
    assert metrics.classifier_metrics(rows, "y", "p", digits=None).first()["auc"] == 1.0


def test_split_and_folds_share_rare_labels(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("event_id"), (F.col("id") % 100 == 0).cast("int").alias("y"))
    counts = {(r.y, r.part): r["count"] for r in classifiers.split_parts(rows, "y").groupBy("y", "part").count().collect()}
    assert counts == {(0, "train"): 792, (0, "test"): 198, (1, "train"): 8, (1, "test"): 2}
    folds = classifiers.stratified_folds(rows, "y", 5).groupBy("y", "fold").count().collect()
    assert sorted((r.y, r["count"]) for r in folds) == [(0, 198)] * 5 + [(1, 2)] * 5


def test_no_model_no_scores(spark):
    passes = spark.createDataFrame([("a", 1)], "event_id string, target int")
    assert classifiers.score_xp(None, passes, keep=("target",)).collect() == []


def test_rank_of_a_million_equal_values(spark, monkeypatch):
    written = {}

    def record(df, tag):
        out = materialise(df, tag)
        written[tag] = max(r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())
        return out

    materialise = running.materialise
    monkeypatch.setattr(running, "materialise", record)
    rows = spark.range(1_000_000).select(F.lit(1).alias("k"), F.when(F.col("id") < 5, F.col("id")).when(F.col("id") < 7, None).otherwise(-1).alias("v"))
    ranked = running.rank_rows(rows, ["k"], "v", "r")
    got = {(r["v"], r["r"]): r["count"] for r in ranked.groupBy("v", "r").count().collect()}
    assert got == {(None, 1): 2, **{(v, 7 - v): 1 for v in range(5)}, (-1, 8): 999_993}
    assert written["ranges"] <= 7  # a row per distinct value, not per row


@pytest.mark.parametrize("window", [0, 1, 5])
def test_actions_after_pairs(spark, window):
    rng = np.random.default_rng(window)
    sides = [[(int(rng.integers(2)), int(rng.integers(2)), f"{n}{i}", int(rng.integers(-20, 60))) for i in range(150)] for n in "ra"]
    sides[0] += [(None, 1, "rn", 3), (1, 1, "rs", None), sides[0][0]]
    begun, done = (spark.createDataFrame(rows, "match_id int, team_id int, event_id string, sec int") for rows in sides)
    got = sequences.actions_after(begun, done, window)
    want = [(m, t, i, j, s, u) for m, t, i, s in sides[0] for m2, t2, j, u in sides[1] if (m, t) == (m2, t2) and s is not None and s <= u <= s + window]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want) and want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "_slot" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
