"""Every registered query on the smallest tables: equal to its SQL, or at least some rows without one."""

from __future__ import annotations

import os

import pytest
from compare import connect, differences

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
# The text queries have tests of their own, where they are present.
OTHER = set(getattr(driver, "TEXT_QUERIES", {})) - set(driver.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(set(driver.oracle_sql())))
def test_equals_sql(spark, con, name):
    assert differences(driver.queries()[name](spark, FOLDER), con, driver.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(driver.queries()) - set(driver.oracle_sql()) - OTHER))
def test_has_rows(spark, name):
    assert driver.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() > 0
    assert "ppda" in df.columns


def test_every_check_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_loaded_models_score_beside_the_fitted_ones(spark, monkeypatch):
    """No score meets another by its event's id, so nothing is stored or moved; a model that came back changed shows."""
    from touchline.operators import classifiers
    from touchline.plans import features, queries

    quick = classifiers.TreeSettings(trees=3, depth=3, rate=0.3)
    fits = {"xg": lambda f: classifiers.train_xg(features.xg_features(f.shots), quick, 0.0, 2),
            "xp": lambda f: classifiers.train_xp(features.xp_features(f.passes), quick)}
    monkeypatch.setattr(queries, "_model", lambda f, name: fits[name](f))
    made = set(queries._MADE)
    whole = queries.QUERIES["model_artifacts"](spark, FOLDER)
    rows = whole.collect()
    assert [r.n_ensembles for r in rows] == [2, 1] and all(r.n_scored == r.n_equal > 0 for r in rows)
    assert set(queries._MADE) == made and "Join [event_id" not in whole._jdf.queryExecution().executedPlan().toString()

    def changed(spark, path, load=classifiers.load_model):
        model = load(spark, path)
        model.rows = [type(r)(**{**r.asDict(), "base": r["base"] + 0.5}) for r in model.rows]
        return model

    monkeypatch.setattr(classifiers, "load_model", changed)
    assert all(r.n_equal < r.n_scored for r in queries.QUERIES["model_artifacts"](spark, FOLDER).collect())


def test_invariants_read_scores_where_they_lie(spark, monkeypatch):
    from touchline.plans.queries import _invariants

    def checked(ids: str, scores: list) -> tuple:
        rows = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "event_id string, target int")
        return tuple(_invariants(spark.createDataFrame(scores, "event_id string, v double"), rows, "v", "target").first())

    assert checked("abcd", [("a", 0.5), ("b", 0.5), ("c", 0.5)]) == (4, 3, 4, 0, True)  # one without a score
    assert checked("abcd", [(i, 0.5) for i in "abce"]) == (4, 3, 4, 0, True)  # a score of some other row
    assert checked("abcd", [(i, 0.5) for i in "abcdd"])[:4] == (5, 5, 4, 0)  # one scored twice
    assert checked("abcd", []) == (4, 0, 4, 0, False)
    joined, frames = [], type(spark.range(1))
    join = frames.join

    def watched(self, other, *args, **kwargs):
        if "v" in other.columns:
            joined.append(other)
        return join(self, other, *args, **kwargs)

    monkeypatch.setattr(frames, "join", watched)
    assert checked("abcd", [(i, 0.5) for i in "dcba"]) == (4, 4, 4, 0, True)
    assert checked("ab", [("a", 1.5), ("b", None)]) == (2, 1, 2, 1, False)
    assert checked("aab", [("a", 0.4), ("b", 0.3), ("a", 0.4)]) == (3, 3, 2, 0, True)  # two events with one id are two rows
    assert not joined
