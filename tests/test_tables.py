"""Stored tables, documents, serving answers and streams."""

from __future__ import annotations

import json
from collections import deque
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline import schemas
from touchline.operators import quality, sequences
from touchline.plans import reports, serving
from touchline.sources import feeds, tables
from touchline.streaming import ingest, stateful


def ids(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def events(spark, rows):
    """rows: (event_id, competition_id, match_id, event_type)"""
    df = spark.createDataFrame(rows, "event_id string, competition_id int, match_id int, event_type string")
    others = [f for f in schemas.EVENT.fields if f.name not in df.columns]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in others]).select(*schemas.EVENT.fieldNames())


def test_append_ignores_known_and_repeated_keys(spark):
    target = spark.createDataFrame([("a", 1, "old")], "event_id string, competition_id int, v string")
    batch = spark.createDataFrame([("a", 1, "new"), ("a", 2, "x"), ("b", 1, "y"), ("b", 1, "y")], target.schema)
    assert ids(tables.append_new(target, batch), *target.columns) == [("a", 1, "old"), ("a", 2, "x"), ("b", 1, "y")]


def test_upsert_and_first_row_per_key(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "z"), (2, None), (3, "c")], "k int, v string")
    assert ids(tables.upsert(target, batch, ["k"]), "k", "v") == [(1, "a"), (2, "z"), (3, "c")]


def test_dimension_drops_null_keys_and_keeps_known_members(spark):
    known = spark.createDataFrame([(1, "Old name", None)], "team_id int, team_name string, country string")
    seen = spark.createDataFrame([(1, "New"), (2, "Two"), (2, "Two"), (None, "x")], "team_id int, team string")
    cols = {"team_name": F.col("team"), "country": F.lit(None).cast("string")}
    got = tables.upsert_dimension(known, seen, "team_id", cols)
    assert ids(got, "team_id", "team_name") == [(1, "Old name"), (2, "Two")]


def test_partitions_and_default(spark, tmp_path):
    rows = events(spark, [("a", 43, 1, "Pass"), ("b", 43, 2, "Shot"), ("c", 7, 3, "Pass")])
    plain = str(tmp_path / "plain")
    tables.write_partitioned(rows, plain)
    assert {p.name for p in Path(plain).glob("competition_id=*")} == {"competition_id=43", "competition_id=7"}
    assert ids(tables.read_events(spark, plain), "event_id", "competition_id") == [("a", 43), ("b", 43), ("c", 7)]
    plan = spark.read.parquet(plain).where("competition_id = 7")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(competition_id" in plan
    known = str(tmp_path / "known")
    tables.write_partitioned(rows, known, known_competitions=[43])
    assert {p.name for p in Path(known).glob("competition=*")} == {"competition=43", "competition=default"}
    assert ids(tables.read_events(spark, known), "event_id", "competition_id") == [("a", 43), ("b", 43), ("c", 7)]


def test_append_events_twice_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "fact")
    first = events(spark, [("a", 43, 1, "Pass"), ("b", 43, 2, "Shot")])
    tables.append_events(spark, first, path)
    tables.append_events(spark, first, path)
    tables.append_events(spark, events(spark, [("b", 43, 2, "Shot"), ("c", 43, 2, "Shot")]), path)
    assert ids(tables.read_events(spark, path), "event_id") == [("a",), ("b",), ("c",)]


def test_older_files_get_default_provenance(spark, tmp_path):
    path = str(tmp_path / "old")
    spark.createDataFrame([("a", 1)], "event_id string, match_id int").write.parquet(path)
    row = tables.read_events(spark, path).first()
    assert (row.provider, row.coord_system, row.under_pressure, row.xt_value) == ("statsbomb", "statsbomb_120x80", False, None)


def test_replace_may_read_what_it_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(spark.range(3).toDF("v"), path)
    got = tables.replace_table(spark.read.parquet(path).select((F.col("v") + 10).alias("v")), path)
    assert ids(got, "v") == [(10,), (11,), (12,)]


def test_refresh_by_name(spark, tmp_path):
    assert tables.refresh("mv_team_xg", spark.range(2), str(tmp_path)).count() == 2
    with pytest.raises(ValueError):
        tables.refresh("users; drop", spark.range(2), str(tmp_path))


def test_model_values_are_written_per_column(spark):
    keys = "event_id string, competition_id int"
    values = spark.createDataFrame([("a", 1, 0.1, 0.2, None), ("b", 1, 0.3, None, None)], f"{keys}, xt_value double, xp_value double, xg_value double")
    scored = spark.createDataFrame([("b", 1, 0.9), ("c", 1, 0.8)], f"{keys}, xp_value double")
    got = ids(tables.write_event_values(values, scored, "xp_value"), "event_id", "xt_value", "xp_value")
    assert got == [("a", 0.1, 0.2), ("b", 0.3, 0.9), ("c", None, 0.8)]


def test_ledger_retries_errors(spark):
    matches = spark.createDataFrame([(1, 43), (2, 43), (3, 9), (4, 43)], "match_id int, competition_id int")
    ledger = spark.createDataFrame([(1, 43, 100, "success", None), (2, 43, 0, "error", None)], schemas.LEDGER)
    assert ids(tables.pending_matches(matches, ledger), "match_id") == [(2,), (3,), (4,)]
    assert ids(tables.pending_matches(matches, ledger, [43]), "match_id") == [(2,), (4,)]
    done = spark.createDataFrame([(2, 43, 50, "success", None), (4, 43, 7, "error", None)], schemas.LEDGER)
    after = tables.mark_ingested(ledger, done)
    assert ids(after, "match_id", "event_count", "status") == [(1, 100, "success"), (2, 0, "success"), (4, 7, "error")]


def test_model_registry(spark, tmp_path):
    path = str(tmp_path / "registry")
    tables.register_model(spark, path, "xp_model", "1.0", {"auc": 0.9, "log_loss": 0.3, "train_size": 10}, "x/y")
    tables.register_model(spark, path, "press_trigger_detector", "1.0", {"press_trigger_count": 165})
    rows = tables.model_history(tables.read_table(spark, path, schemas.REGISTRY)).collect()
    assert {(r.model_name, r.auc, r.train_size) for r in rows} == {("xp_model", "0.9", "10"), ("press_trigger_detector", None, None)}
    assert rows[0].trained_at >= rows[1].trained_at


# --- clips and documents ----------------------------------------------------------------------------------

CLIP = (
    "event_id string, match_id int, team_id int, player_id int, event_type string, minute int, second int, location_x double, "
    "location_y double, end_location_x double, end_location_y double, under_pressure boolean, xt_value double, xg_value double"
)


def clip_list(spark, rows):
    players = spark.createDataFrame([(1, "Ada B")], "player_id int, player_name string")
    teams = spark.createDataFrame([(9, "Reds")], "team_id int, team_name string")
    return reports.clips(spark.createDataFrame(rows, CLIP), players, teams)


def test_clips(spark, tmp_path):
    rows = [
        ("a", 5, 9, 1, "Pass", 0, 1, 10.0, 20.0, 30.25, 40.0, True, 0.12345, None),
        ("b", 5, 9, None, "Carry", 10, 0, 1.0, 2.0, None, None, False, 0.5, 0.25),
        ("c", 5, 9, 1, "Shot", 10, 0, 1.0, 2.0, None, None, False, 0.9, 0.25),
        ("d", 6, 9, 1, "Pass", 10, 0, 1.0, 2.0, 3.0, 4.0, False, -0.1, None),
    ]
    clips = clip_list(spark, rows).persist()
    got = {r.event_id: r for r in clips.collect()}
    assert set(got) == {"a", "b", "d"} and (got["b"]["rank"], got["a"]["rank"], got["d"]["rank"]) == (1, 2, 1)
    assert (got["a"].start_ms, got["a"].end_ms, got["a"].code) == (0, 6000, "xT_ACTION_02")
    assert (got["b"].start_ms, got["b"].end_ms) == (597000, 605000)
    assert got["a"].label == "xT: 0.1235 | Type: Pass | Player: Ada B | Team: Reds | From: (10.0, 20.0) | To: (30.2, 40.0) | Under Pressure: Yes"
    assert got["b"].label == "xT: 0.5000 | xG: 0.2500 | Type: Carry | Player: Unknown | Team: Reds | From: (1.0, 2.0)"
    path = str(tmp_path / "xml")
    tables.write_clips_xml(clips, path)
    (file,) = Path(path).glob("match_id=5/*.txt")
    text = file.read_text()
    assert text.startswith("<file><ALL_INSTANCES><instance>") and "</ALL_INSTANCES><SEQUENCE>" in text
    for part in ("<action_count>2</action_count>", "<ID>1</ID>", "<code>xT_ACTION_02</code>", "<pos_x>10.00</pos_x>", "<xt_value>0.500000</xt_value>", "<player>Unknown</player>"):
        assert part in text
    assert text.count("<instance>") == 2 and text.count("<end_pos_x>") == 1
    back = spark.read.format("xml").option("rowTag", "instance").load(f"{path}/match_id=6")
    assert [(r["ID"], r["label"]["event_type"]) for r in back.collect()] == [(1, "Pass")]


def test_match_document(spark):
    summary = spark.createDataFrame(
        [(1, "A", "B", 2, 1, 1.5, 0.25, 1.25, 8.0, None, "High", "N/A")],
        "match_id int, home_team string, away_team string, home_score int, away_score int, xg_home double, xg_away double, "
        "xg_diff double, home_ppda double, away_ppda double, home_pressing string, away_pressing string",
    )
    threats = spark.createDataFrame([(1, 2, "Q", "B", 0.1), (1, 1, "P", "A", 0.2)], "match_id int, rank int, player_name string, team_name string, total_xt double")
    doc = json.loads(serving.match_documents(summary, threats).first().document)
    assert doc["pressing_intensity"] == {"home": {"label": "High", "ppda": 8.0}, "away": {"label": "N/A", "ppda": None}}
    assert [t["player_name"] for t in doc["key_threats"]] == ["P", "Q"] and doc["xg_diff"] == 1.25
    assert json.loads(serving.match_documents(summary, threats.where("false")).first().document)["key_threats"] == []
    assert json.loads(tables.to_json_docs(summary, "match_id").first().document)["away_ppda"] is None


def test_xg_page(spark):
    rows = spark.createDataFrame([(m, f"e{i:02d}", i / 100) for m in (1, 2) for i in range(10)], "match_id int, event_id string, xg_value double")
    assert [r.event_id for r in serving.xg_values(rows, 1, limit=3, offset=2).collect()] == ["e02", "e03", "e04"]
    assert serving.xg_values(rows, limit=3, offset=2).count() == 6
    with pytest.raises(ValueError):
        serving.xg_values(rows, 1, limit=2001)


def test_replacement(spark):
    players = spark.createDataFrame([(1, "One", "Wing"), (2, "Two", "Back"), (3, "Three", "Back")], "player_id int, player_name string, position string")
    figures = spark.createDataFrame(
        [(1, "T", 0.1, 80.0, 0.01, 5), (2, "T", 0.2, 70.0, 0.02, 9), (2, "U", 0.3, 60.0, 0.03, 1)],
        "player_id int, team_name string, avg_xg double, pass_completion_pct double, avg_xt_per_pass double, total_shots int")
    scores = spark.createDataFrame([(1, 2, 0.9, 1), (1, 3, 0.8, 2)], "player_id int, similar_player_id int, similarity_score double, rank int")
    got = serving.replacement_candidates(scores, players, figures, player_id=1, top_n=3).orderBy("slot").collect()
    assert [(r.similar_player_id, r.team_name) for r in got] == [(2, "T"), (2, "U"), (3, None)]
    assert (got[0].delta_xg, got[0].delta_pct, got[0].delta_xt) == (0.1, -10.0, 0.01) and got[2].avg_xg == 0.0
    text = dict(ids(serving.recommendations(serving.replacement_candidates(scores, players, figures), players), "player_id", "recommendation"))
    assert text[1] == ("Replacing One: best match is Two (similarity 0.90). xG/shot 0.200 vs 0.100 (higher), "
                       "pass completion 70.0% vs 80.0% (lower).")  # fmt: skip
    assert text[2].startswith("No replacement candidates found for Two")
    assert ids(serving.similar_players(scores, players, 1, position="Back", n=50), "rank") == [(1,), (2,)]


# --- streams ----------------------------------------------------------------------------------------------


def test_ingest_stream_loads_each_file_once(spark, tmp_path):
    feed, fact, ledger, progress = (str(tmp_path / n) for n in ("feed", "fact", "ledger", "progress"))
    Path(feed).mkdir()

    def put(match, *names):
        Path(feed, f"{match}.json").write_text(json.dumps([{"id": n, "minute": 1, "type": {"name": "Pass"}} for n in names]))

    def run():
        ingest.stream_ingest(spark, "statsbomb", feed, fact, ledger, progress, competition_id=43).awaitTermination()
        return ids(tables.read_events(spark, fact), "match_id", "event_id")

    put(1, "a", "b", "b")
    assert run() == [(1, "a"), (1, "b")]
    assert run() == [(1, "a"), (1, "b")]
    put(2, "c")
    assert run() == [(1, "a"), (1, "b"), (2, "c")]
    assert ids(tables.read_table(spark, ledger, schemas.LEDGER), "match_id", "status") == [(1, "success"), (2, "success")]


def micro_batches(spark, tmp_path, batches, schema):
    """A stream that reads one small file per micro-batch, in order."""
    folder = tmp_path / "in"
    folder.mkdir()
    import os

    for i, rows in enumerate(batches):
        part = folder / f"{i:03d}.json"
        part.write_text("\n".join(json.dumps(r) for r in rows))
        os.utime(part, (1_700_000_000 + i, 1_700_000_000 + i))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))


PRESS = "event_id string, match_id int, team_id int, event_type string, sec long"


def test_press_stream_equals_batch_for_rows_on_time(spark, tmp_path):
    rng = np.random.default_rng(31)
    kinds = ["Ball Recovery", "Pressure", "Tackle", "Pass"]
    rows = [{"event_id": f"e{i}", "match_id": int(rng.integers(1, 3)), "team_id": int(rng.integers(1, 3)),
             "event_type": kinds[rng.integers(0, 4)], "sec": int(s)} for i, s in enumerate(sorted(rng.integers(0, 240, 300)))]
    batches = [rows[i : i + 60] for i in range(0, 300, 60)]
    stream = micro_batches(spark, tmp_path, batches, PRESS).withColumn("event_time", F.timestamp_seconds("sec"))
    got = ids(ingest.run_to_table(stateful.stream_press_triggers(stream), "t"), "event_id")
    static = spark.createDataFrame([(r["event_id"], r["match_id"], r["team_id"], r["event_type"], r["sec"] // 60, r["sec"] % 60) for r in rows],
                                   "event_id string, match_id int, team_id int, event_type string, minute int, second int")
    assert got == ids(sequences.press_triggers(static), "event_id") and got


def test_dedup_stream(spark, tmp_path):
    def row(i, s):
        return {"event_id": i, "competition_id": 1, "sec": s}

    batches = [[row("a", 0), row("a", 5), row("b", 6)], [row("a", 10), row("c", 12)]]
    stream = micro_batches(spark, tmp_path, batches, "event_id string, competition_id int, sec long")
    once = ingest.stream_dedup(stream.withColumn("event_time", F.timestamp_seconds("sec")), "event_time")
    assert ids(ingest.run_to_table(once, "d"), "event_id") == [("a",), ("b",), ("c",)]


def sequential_limit(times, limit, window):
    """The rule spelled out: only accepted requests count, one exactly at the edge still does."""
    accepted, out = [], []
    for t in times:
        recent = [a for a in accepted if a >= t - window]
        out.append(len(recent) < limit)
        if out[-1]:
            accepted.append(t)
    return out


def test_request_limit_counts_accepted_only(spark, tmp_path):
    rng = np.random.default_rng(37)
    times = sorted(int(t) for t in rng.integers(0, 600, 250))
    assert list(stateful.accept(np.array(times), deque(), 20, 60)) == sequential_limit(times, 20, 60)
    rows = [{"request_id": f"r{i:03d}", "user": "u", "sec": t} for i, t in enumerate(times)]
    stream = micro_batches(spark, tmp_path, [rows[:100], rows[100:180], rows[180:]], "request_id string, user string, sec long")
    timed = stream.withColumn("ts", F.timestamp_seconds("sec"))
    got = ids(ingest.run_to_table(stateful.stream_request_limit(timed, "user", "request_id", "ts", 20, 60), "l"), "request_id", "accepted")
    assert [a for _, a in got] == sequential_limit(times, 20, 60) and not all(a for _, a in got)


def test_ingest_records_errors_and_retries(spark, tmp_path):
    feed, fact, ledger, progress = (str(tmp_path / n) for n in ("feed", "fact", "ledger", "progress"))
    Path(feed).mkdir()

    def run():
        ingest.stream_ingest(spark, "statsbomb", feed, fact, ledger, progress, competition_id=43).awaitTermination()
        return ids(tables.read_table(spark, ledger, schemas.LEDGER), "match_id", "status", "event_count")

    Path(feed, "1.json").write_text('[{"id": "a", "minute": 1}]')
    Path(feed, "bad_77.json").write_text('[{"id": "b", "minute": 1}, {"id": "c", "min')
    Path(feed, "nameless.json").write_text('[{"id": "d"}]')
    Path(feed, "8.json").write_text('[{"id": "e"}, {"minute": 3}]')
    assert run() == [(1, "success", 1), (8, "error", 0), (77, "error", 0)]
    assert ids(tables.read_events(spark, fact), "event_id") == [("a",)]
    matches = spark.createDataFrame([(1, 43), (8, 43), (77, 43)], "match_id int, competition_id int")
    assert ids(tables.pending_matches(matches, tables.read_table(spark, ledger, schemas.LEDGER)), "match_id") == [(8,), (77,)]
    Path(feed, "77_again.json").write_text('[{"id": "b", "minute": 1}, {"id": "c", "minute": 2}]')
    assert (77, "success", 0) in run()  # a known match keeps its first count
    assert ids(tables.read_events(spark, fact), "event_id") == [("a",), ("b",), ("c",)]


def test_file_mended_in_place_is_loaded_by_the_next_run(spark, tmp_path):
    feed, fact, ledger, progress = (str(tmp_path / n) for n in ("feed", "fact", "ledger", "progress"))
    Path(feed).mkdir()

    def run():
        ingest.stream_ingest(spark, "statsbomb", feed, fact, ledger, progress, competition_id=43).awaitTermination()
        return ids(tables.read_table(spark, ledger, schemas.LEDGER), "match_id", "status")

    assert ingest.retry_failed(spark, "statsbomb", feed, fact, ledger) == 0  # no ledger yet
    Path(feed, "1.json").write_text('[{"id": "a", "minute": 1}]')
    Path(feed, "2.json").write_text('[{"id": "b", "min')
    Path(feed, "3.json").write_text("[")
    assert run() == [(1, "success"), (2, "error"), (3, "error")]
    assert run() == [(1, "success"), (2, "error"), (3, "error")]  # tried again, still broken
    Path(feed, "2.json").write_text('[{"id": "b", "minute": 1}, {"id": "c", "minute": 2}]')
    Path(feed, "4.json").write_text('[{"id": "d", "minute": 1}]')
    assert run() == [(1, "success"), (2, "success"), (3, "error"), (4, "success")]
    assert ids(tables.read_events(spark, fact), "match_id", "event_id") == [(1, "a"), (2, "b"), (2, "c"), (4, "d")]
    failed = tables.read_table(spark, ledger, schemas.LEDGER).where("status <> 'success'")
    assert [p.rsplit("/", 1)[1] for p in feeds.files_of(spark, feed, failed)] == ["3.json"]
    Path(feed, "3.json").write_text("[]")
    assert (3, "success") in run()
    assert ingest.retry_failed(spark, "statsbomb", feed, fact, ledger) == 0


def test_null_keys_are_refused(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), (None, 1), ("b", None)], "event_id string, competition_id int")
    assert ids(tables.new_rows(rows.limit(0), rows), "event_id") == [("a",)]


def test_replace_recovers_a_table_moved_aside(spark, tmp_path):
    path = tmp_path / "t"
    tables.replace_table(spark.range(3).toDF("v"), str(path))
    path.rename(tmp_path / "t__replaced")  # as a crash between the two moves leaves it
    got = tables.replace_table(spark.range(5).toDF("v"), str(path))
    assert got.count() == 5 and not (tmp_path / "t__replaced").exists()


def test_events_of_a_query_are_mapped_in_its_scan(spark):
    """Nothing is moved or stored before the query's own work: the scan of the order lines is all there is."""
    from touchline.plans.football import Football

    f = Football(spark, "/root/testdata/sf0.001")
    rows = quality.check_accepted_values(f.silver, "provider", ("statsbomb", "opta")).select("event_id", "provider")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "lineitem.parquet" in plan and "fact_events" not in plan
    assert "l_quantity" not in plan  # only the columns it needs are read


def test_score_table_is_searched_once(spark, monkeypatch):
    """Every query on similar players reads one stored table, and none of them runs the search a second time."""
    from touchline.operators import similarity
    from touchline.plans import queries
    from touchline.plans.football import Football

    searched = []
    monkeypatch.setattr(queries, "_MADE", {})
    stub = spark.createDataFrame([(1, 2, 0.9, 1)], "player_id int, similar_player_id int, similarity_score double, rank int")
    monkeypatch.setattr(similarity, "player_similarity", lambda *args, **kwargs: searched.append(1) or stub)
    f = Football(spark, "/root/testdata/sf0.001")
    assert queries._first_neighbours(f).count() == 1 and queries._scores(f).count() == 1
    assert len(searched) == 1
