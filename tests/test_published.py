"""Joint publication, increments of a view, bucketed tables."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from touchline import schemas
from touchline.operators import quality
from touchline.plans import gold
from touchline.sources import published, tables
from touchline.streaming import ingest


def ids(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def events(spark, rows):
    """rows: (event_id, match_id, team_id, event_type, outcome, xg_value), all of competition 43"""
    df = spark.createDataFrame(rows, "event_id string, match_id int, team_id int, event_type string, outcome string, xg_value double")
    df = df.withColumn("competition_id", F.when(F.col("event_id") != "", 43))  # no constant, which a plan would leave out
    others = [f for f in schemas.EVENT.fields if f.name not in df.columns]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in others]).select(*schemas.EVENT.fieldNames())


def outcomes(spark, *matches):
    return spark.createDataFrame([(m, 43, 1, "success", None) for m in matches], schemas.LEDGER)


def state(spark, root):
    rows = ids(published.read_events(spark, root), "match_id", "event_id")
    return rows, ids(published.read(spark, root, published.LEDGER, schemas.LEDGER), "match_id")


@pytest.mark.parametrize("step", range(4))
def test_a_crash_shows_neither_events_nor_ledger(spark, tmp_path, monkeypatch, step):
    """Before the events, after them, after the ledger's folder and within the list: the old state, then all of the new."""
    root = str(tmp_path / "p")
    published.publish_events(spark, root, events(spark, [("a", 1, 9, "Pass", None, None)]), outcomes(spark, 1))
    before = state(spark, root)
    assert before == ([(1, "a")], [(1,)])
    batch, done = events(spark, [("a", 1, 9, "Pass", None, None), ("b", 2, 9, "Shot", None, 0.5)]), outcomes(spark, 1, 2)
    whole = tables.write_partitioned
    listed = published._list

    def fail(*_):
        raise OSError("lost")

    def written_then_lost(df, path, *rest):
        whole(df, path, *rest)
        raise OSError("lost")

    def list_cut_short(session, folder, now):
        Path(folder, published.LISTS, "half.tmp").write_text(json.dumps(now)[:20])
        raise OSError("lost")

    with monkeypatch.context() as broken:
        if step < 2:
            broken.setattr(tables, "write_partitioned", (fail, written_then_lost)[step])
        else:
            broken.setattr(published, "_list", (fail, list_cut_short)[step - 2])
        with pytest.raises(OSError, match="lost"):
            published.publish_events(spark, root, batch, done)
        assert state(spark, root) == before
    assert published._list is listed
    for _ in range(2):  # and a replay changes nothing
        published.publish_events(spark, root, batch, done)
        assert state(spark, root) == ([(1, "a"), (2, "b")], [(1,), (2,)])


def test_failed_checks_publish_nothing(spark, tmp_path):
    root = str(tmp_path / "p")
    good = [("a", 1, 9, "Shot", "Goal", 0.25), ("b", 1, 8, "Shot", None, 0.5)]
    checks = {published.EVENTS: {"type": F.col("event_type").isNull(), "xg_range": quality.outside("xg_value", 0, 1)}}
    published.publish(spark, root, add={published.EVENTS: events(spark, good)}, checks=checks)
    before = state(spark, root)
    bad = [("c", 2, 9, "Shot", None, 1.5), ("d", 2, 9, None, None, 7.0), ("e", 2, 9, "Pass", None, None)]
    with pytest.raises(quality.GateError, match=r"events.type: 1, events.xg_range: 2"):
        published.publish(spark, root, add={published.EVENTS: events(spark, bad), "other": spark.range(3)}, checks=checks)
    assert state(spark, root) == before and "other" not in published.folders(spark, root)
    # Tables that have no checks, and empty ones that have some, go through.
    published.publish(spark, root, add={published.EVENTS: events(spark, bad).where("event_id = 'none'"), "other": spark.range(3)}, checks=checks)
    assert state(spark, root) == before and "other" in published.folders(spark, root)


@pytest.mark.parametrize("n", [0, 1, 1000])
def test_watched_write_counts_as_the_tally(spark, tmp_path, n):
    rows = [(f"e{i}" if i % 7 else None, i % 5, 9, "Shot" if i % 3 else None, None, float(i % 4) - 1) for i in range(n)]
    df = events(spark, rows).repartition(7)
    checks = {"id": F.col("event_id").isNull(), "type": F.col("event_type").isNull(), "xg": quality.outside("xg_value", 0, 1),
              "none": F.col("match_id") < 0}
    watch = quality.Watch(checks)
    tables.write_partitioned(df, str(tmp_path / "t"), watch=watch.on)
    assert ids(watch.tallies(spark), "check", "failing") == ids(quality.tally(df, checks), "check", "failing")


def test_watch_of_a_plain_write(spark, tmp_path):
    watch = quality.Watch({"id": F.col("id").isNull()})
    watched = watch.on(spark.range(3))
    watched.write.parquet(str(tmp_path / "t"))
    assert watch.failing() == {"id": 0}


def test_two_writers_are_noticed(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "p")
    published.publish(spark, root, add={"t": spark.range(2)})
    monkeypatch.setattr(published, "_numbers", lambda *_: [])
    with pytest.raises(OSError, match="another writer"):
        published._list(spark, root, {})


def test_nothing_published_is_empty(spark, tmp_path):
    root = str(tmp_path / "none")
    assert published.folders(spark, root) == {} and state(spark, root) == ([], [])
    assert published.refresh_partials(spark, root, "team_xg", gold.team_xg_partials) == []


def test_view_reads_new_folders_only(spark, tmp_path):
    root = str(tmp_path / "p")
    teams = spark.createDataFrame([(9, "Reds"), (8, "Blues"), (7, "Reds")], "team_id int, team_name string")
    first = [("a", 1, 9, "Shot", "Goal", 0.25), ("b", 1, 8, "Shot", None, 0.5), ("c", 1, 7, "Shot", None, None), ("d", 1, 9, "Pass", None, None)]
    second = [("e", 1, 9, "Shot", "Goal", 0.125), ("f", 2, 8, "Shot", "Goal", 0.75)]  # match 1 goes on in the second load
    seen = []

    def build(rows):
        seen.append(ids(rows, "event_id"))
        return gold.team_xg_partials(rows)

    def view():
        return ids(gold.team_xg_of(published.read(spark, root, "team_xg", schemas.TEAM_XG_PARTIALS), teams), *full.columns)

    full = gold.mv_team_xg(events(spark, first), teams)
    published.publish(spark, root, add={published.EVENTS: events(spark, first)})
    assert len(published.refresh_partials(spark, root, "team_xg", build)) == 1 and view() == ids(full, *full.columns)
    published.publish(spark, root, add={published.EVENTS: events(spark, second)})
    assert len(published.refresh_partials(spark, root, "team_xg", build)) == 1
    both = ids(gold.mv_team_xg(events(spark, first + second), teams), *full.columns)
    assert view() == both and seen[-1] == [("e",), ("f",)]
    assert published.refresh_partials(spark, root, "team_xg", build) == [] and len(seen) == 2
    published.compact(spark, root, published.EVENTS, schemas.EVENT)
    assert len(published.folders(spark, root)[published.EVENTS]) == 1
    assert len(published.refresh_partials(spark, root, "team_xg", build)) == 1 and view() == both and len(seen[-1]) == 6
    assert len(published.refresh_partials(spark, root, "team_xg", build, rebuild=True)) == 1 and view() == both


def test_streams_into_published_tables(spark, tmp_path):
    feed, root, progress = (str(tmp_path / n) for n in ("feed", "p", "progress"))
    Path(feed).mkdir()

    def run():
        ingest.stream_publish(spark, "statsbomb", feed, root, progress, competition_id=43).awaitTermination()
        return state(spark, root)[0], ids(published.read(spark, root, published.LEDGER, schemas.LEDGER), "match_id", "status")

    Path(feed, "1.json").write_text('[{"id": "a", "minute": 1}, {"id": "a", "minute": 1}]')
    Path(feed, "2.json").write_text('[{"id": "b", "min')
    assert run() == ([(1, "a")], [(1, "success"), (2, "error")])
    Path(feed, "2.json").write_text('[{"id": "b", "minute": 3}]')
    assert run() == ([(1, "a"), (2, "b")], [(1, "success"), (2, "success")])
    assert published.read_events(spark, root).where("provider = 'statsbomb' AND competition_id = 43").count() == 2


def above_scans(df):
    """The operators of the plan that stored rows pass on their way."""
    path, above = [], []
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        path = [entry for entry in path if entry[0] < depth]
        if "Scan parquet" in line:
            above += [text for _, text in path]
        path.append((depth, line))
    return above


def test_bucketed_tables_join_without_an_exchange(spark, tmp_path):
    rows = events(spark, [(f"e{i}", i % 7, 9, "Shot" if i % 3 else "Pass", None, i / 64) for i in range(200)])
    fact = tables.write_bucketed(rows.drop("xt_value", "xp_value", "xg_value"), "bucketed_fact", str(tmp_path / "fact"))
    values = tables.write_bucketed(tables.event_values(rows), "bucketed_values", str(tmp_path / "values"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = [tables.with_event_values(fact, values, how) for how in ("left", "inner")]
        # New rows (A6) and newly written values (A11): what arrives is moved, what is stored is not.
        batch = events(spark, [("e5", 5, 9, "Shot", None, 0.1), ("new", 5, 9, "Shot", None, 0.1)])
        added = tables.new_rows(fact, batch.select(*fact.columns))
        written = tables.write_event_values(values, batch, "xg_value")
        for df in joined:
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        for df in (added, written):
            assert above_scans(df) and not any("Exchange" in line for line in above_scans(df))
        assert ids(written.where("event_id IN ('e5', 'new', 'e6')"), "event_id", "xg_value") == [("e5", 0.1), ("e6", 0.09375), ("new", 0.1)]
        assert joined[0].count() == joined[1].count() == 200 and ids(added, "event_id") == [("new",)]
        plain = tables.with_event_values(rows.drop("xt_value", "xp_value", "xg_value"), tables.event_values(rows))
        assert ids(joined[0], "event_id", "xg_value") == ids(plain, "event_id", "xg_value")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql("DROP TABLE bucketed_fact")
        spark.sql("DROP TABLE bucketed_values")
