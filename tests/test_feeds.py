"""Provider feeds and bulk rows to canonical events."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import types as T

from touchline import schemas
from touchline.sources import feeds


def write(folder, name, document):
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text(json.dumps(document))
    return str(path)


def rows(df):
    return [r.asDict() for r in df.collect()]


def sb(**extra):
    return {"id": "a1", "minute": 3, "second": 7, "type": {"name": "Pass"}, "team": {"id": 9}, "player": {"id": 77},
            "location": [60.0, 40.0], **extra}


@pytest.mark.parametrize(
    "event, expected",
    [
        (sb(), {"event_type": "Pass", "location_x": 60.0, "location_y": 40.0, "outcome": "Unknown",
                "under_pressure": False, "end_location_x": None, "match_id": 321, "minute": 3, "player_id": 77}),
        (sb(location=None), {"location_x": None, "location_y": None}),
        (sb(location=[5.0]), {"location_x": 5.0, "location_y": None}),
        (sb(type=None), {"event_type": "Unknown"}),
        (sb(minute=None, second=None), {"minute": 0, "second": 0}),
        (sb(under_pressure=True), {"under_pressure": True}),
        (sb(**{"pass": {"end_location": [80.0, 30.0], "outcome": {"name": "Incomplete"}}}),
         {"end_location_x": 80.0, "end_location_y": 30.0, "outcome": "Incomplete"}),
        (sb(**{"pass": {"end_location": [80.0, 30.0]}}), {"outcome": "Unknown"}),
        (sb(carry={"end_location": [70.0, 20.0]}), {"end_location_x": 70.0}),
        (sb(shot={"end_location": [120.0, 40.0, 1.0], "outcome": {"name": "Goal"}}),
         {"end_location_x": 120.0, "outcome": "Goal"}),
        (sb(duel={"outcome": {"name": "Won"}}), {"outcome": "Won"}),
    ],
)
def test_statsbomb(spark, tmp_path, event, expected):
    path = write(tmp_path / "f", "321.json", [event])
    (got,) = rows(feeds.read_statsbomb(spark, path, competition_id=43))
    assert {k: got[k] for k in expected} == expected
    assert (got["provider"], got["coord_system"], got["competition_id"]) == ("statsbomb", "statsbomb_120x80", 43)


def test_statsbomb_payload_feeds_later_layers(spark, tmp_path):
    event = sb(**{"pass": {"recipient": {"id": 5}}})
    (got,) = rows(feeds.read_statsbomb(spark, write(tmp_path / "f", "1.json", [event])))
    assert json.loads(got["raw_json"])["pass"]["recipient"]["id"] == 5


def opta(**extra):
    base = {"EventId": 42, "TypeId": 1, "Min": 5, "Sec": 10, "TeamId": 1, "PlayerId": 100, "Outcome": 1}
    return {k: v for k, v in {**base, **extra}.items() if v != "drop"}


@pytest.mark.parametrize(
    "event, expected",
    [
        (opta(), {"event_id": "42", "event_type": "Pass", "outcome": "Unknown", "location_x": None,
                  "under_pressure": False}),
        (opta(X=55, Y=40), {"location_x": 55.0, "location_y": 40.0}),
        (opta(EndX=80.5, EndY=12), {"end_location_x": 80.5, "end_location_y": 12.0}),
        (opta(TypeId=999), {"event_type": "Unknown"}),
        (opta(TypeId="drop"), {"event_type": "Unknown"}),
        (opta(TypeId=16), {"event_type": "Shot"}),
        (opta(TypeId=74), {"event_type": "Keeper Sweeper"}),
        (opta(Outcome=0), {"outcome": "Fail"}),
        (opta(Outcome="drop"), {"outcome": "Fail"}),
        (opta(Qualifiers=[{"QualifierId": 1}, {"QualifierId": 72, "Value": "1"}]), {"under_pressure": True}),
        (opta(Qualifiers=[{"QualifierId": 56}]), {"under_pressure": False}),
        (opta(EventId="drop"), {"event_id": "7_5_10"}),
        (opta(Min="drop", Sec="drop"), {"minute": 0, "second": 0}),
    ],
)
def test_opta(spark, tmp_path, event, expected):
    path = write(tmp_path / "f", "f24-7.json", {"Events": [event]})
    (got,) = rows(feeds.read_opta(spark, path))
    assert {k: got[k] for k in expected} == expected
    assert got["match_id"] == 7 and got["provider"] == "opta"


def wys(**extra):
    base = {"id": 500, "minute": 12, "second": 30, "type": {"primary": "pass", "secondary": []}, "team": {"id": 3},
            "player": {"id": 8}, "location": {"x": 40, "y": 60}}
    return {k: v for k, v in {**base, **extra}.items() if v != "drop"}


@pytest.mark.parametrize(
    "event, expected",
    [
        (wys(), {"event_id": "500", "event_type": "Pass", "outcome": "Unknown", "location_x": 40.0}),
        (wys(**{"pass": {"accurate": True, "endLocation": {"x": 70, "y": 45}}}),
         {"outcome": "Success", "end_location_x": 70.0, "end_location_y": 45.0}),
        (wys(**{"pass": {"accurate": False}}), {"outcome": "Fail"}),
        (wys(**{"pass": {"endLocation": {"x": 1, "y": 2}}}), {"outcome": "Fail"}),
        (wys(type={"primary": "shot"}, shot={"isGoal": True}), {"event_type": "Shot", "outcome": "Goal"}),
        (wys(type={"primary": "shot"}, shot={"onTarget": True}), {"outcome": "Saved"}),
        (wys(type={"primary": "shot"}, shot={"isGoal": False, "onTarget": False}), {"outcome": "Off Target"}),
        (wys(carry={"endLocation": {"x": 9, "y": 8}}), {"end_location_x": 9.0}),
        (wys(type={"primary": "pass", "secondary": ["x", "under_pressure"]}), {"under_pressure": True}),
        (wys(type={"primary": "mystery"}), {"event_type": "Unknown"}),
        (wys(type="drop"), {"event_type": "Unknown", "under_pressure": False}),
        (wys(type={"primary": "goalkeeper_reflex"}), {"event_type": "Goalkeeper Save"}),
        (wys(location="drop"), {"location_x": None}),
        (wys(id="drop"), {"event_id": "9_12_30"}),
    ],
)
def test_wyscout(spark, tmp_path, event, expected):
    path = write(tmp_path / "f", "9.json", {"events": [event]})
    (got,) = rows(feeds.read_wyscout(spark, path))
    assert {k: got[k] for k in expected} == expected
    assert got["coord_system"] == "wyscout_100x100"


def test_documents_without_events_give_no_rows(spark, tmp_path):
    assert feeds.read_opta(spark, write(tmp_path / "o", "1.json", {})).count() == 0
    assert feeds.read_wyscout(spark, write(tmp_path / "w", "1.json", {"meta": 1})).count() == 0


def test_a_folder_of_matches_and_the_union(spark, tmp_path):
    write(tmp_path / "s", "11.json", [sb(), sb(id="a2")])
    write(tmp_path / "s", "12.json", [sb(id="a3")])
    write(tmp_path / "o", "13.json", {"Events": [opta()]})
    all_events = feeds.union_providers(
        feeds.read_statsbomb(spark, str(tmp_path / "s")), feeds.read_opta(spark, str(tmp_path / "o"))
    )
    assert all_events.schema.fieldNames() == schemas.FEED_EVENT.fieldNames()
    assert sorted((r.match_id, r.event_id) for r in all_events.collect()) == [
        (11, "a1"), (11, "a2"), (12, "a3"), (13, "42"),
    ]


def test_unknown_provider_is_refused(spark):
    with pytest.raises(ValueError):
        feeds.read_feed(spark, "other", "x")


_NAME = T.StructType([T.StructField("name", T.StringType())])
_KINDS = {"int": T.IntegerType(), "string": T.StringType(), "boolean": T.BooleanType(), "name": _NAME,
          "point": T.ArrayType(T.IntegerType())}
FLAT = T.StructType([
    T.StructField(name, _KINDS[kind]) for name, kind in (part.split(":") for part in (
        "id:string team_id:int team:string player_id:int player:string position:name type:name minute:int second:int "
        "location:point under_pressure:boolean pass_end_location:point carry_end_location:point "
        "shot_end_location:point pass_outcome:string shot_outcome:string duel_outcome:string clearance_outcome:string"
    ).split())
])


def flat(i, **extra):
    base = dict(id=f"00000000-0000-0000-0000-00000000000{i}", team_id=1, team="A", player_id=i, player=f"P{i}",
                position={"name": "Wing"}, type={"name": "Pass"}, minute=1, second=2, location=[60, 40])
    row = {**base, **extra}
    return tuple(row.get(f.name) for f in FLAT.fields)


def test_flatten_events(spark):
    data = [
        flat(0, pass_end_location=[80, 30], pass_outcome="Incomplete"),
        flat(1, carry_end_location=[70, 20]),
        flat(2),
        flat(3, location=[5], shot_outcome="Goal", shot_end_location=[120]),
        flat(4, id=None, duel_outcome="Won", clearance_outcome="x", under_pressure=True),
    ]
    df = feeds.flatten_events(spark.createDataFrame(data, FLAT), 10, 43)
    got = {r.player_id: r for r in df.collect()}
    assert got[0].end_location_x == 80.0 and got[0].outcome == "Incomplete"
    assert got[1].end_location_x == 70.0 and got[1].outcome is None
    assert got[2].end_location_x is None and got[2].under_pressure is False
    assert got[3].location_x == 5.0 and got[3].location_y is None
    assert got[3].end_location_x is None and got[3].outcome == "Goal"
    assert got[4].outcome == "Won" and got[4].under_pressure and len(got[4].event_id) == 36
    assert {r.xt_value for r in got.values()} == {None} and got[0].event_type == "Pass"
    again = {r.player_id: r.event_id for r in df.collect()}
    assert again[4] == got[4].event_id


def test_payload_is_the_event_as_delivered(spark, tmp_path):
    event = {"id": "x", "type": {"name": "Pass"}, "possession": 7, "pass": {"length": 1.5, "height": {"name": "Low"}}}
    (got,) = rows(feeds.read_statsbomb(spark, write(tmp_path / "f", "18245_v3.json", [event])))
    assert json.loads(got["raw_json"]) == event and got["match_id"] == 18245


def test_broken_and_nameless_files(spark, tmp_path):
    folder = Path(write(tmp_path / "f", "5.json", [{"id": "x"}])).parent
    (folder / "bad_77.json").write_text('[{"id": "y"}, {"id"')
    (folder / "match.json").write_text('[{"id": "z"}]')
    files = spark.read.option("wholetext", True).text(str(folder))
    got = {(r.match_id, r.error) for r in feeds.documents(files, "statsbomb").collect()}
    assert got == {(5, None), (77, "broken JSON"), (None, "no match id in the file name")}
    assert [r["event_id"] for r in rows(feeds.read_statsbomb(spark, str(folder)))] == ["x"]
