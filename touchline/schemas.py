"""Declared schemas: the canonical event, the dimensions, the result tables and the provider feeds."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


INT, SMALL, LONG, DBL = T.IntegerType(), T.ShortType(), T.LongType(), T.DoubleType()
STR, BOOL, TS = T.StringType(), T.BooleanType(), T.TimestampType()

FEED_EVENT = _struct(
    ("event_id", STR), ("match_id", INT), ("competition_id", INT), ("team_id", INT), ("player_id", INT),
    ("event_type", STR), ("minute", SMALL), ("second", SMALL), ("location_x", DBL), ("location_y", DBL),
    ("end_location_x", DBL), ("end_location_y", DBL), ("outcome", STR), ("under_pressure", BOOL),
    ("provider", STR), ("coord_system", STR), ("raw_json", STR),
)

EVENT = T.StructType(
    FEED_EVENT.fields
    + _struct(("xt_value", DBL), ("xp_value", DBL), ("xg_value", DBL), ("ingested_at", TS)).fields
)

COMPETITIONS = _struct(("competition_id", INT), ("competition_name", STR), ("country_name", STR))
SEASONS = _struct(("season_id", INT), ("season_name", STR))
MATCHES = _struct(
    ("match_id", INT), ("competition_id", INT), ("season_id", INT), ("match_date", T.DateType()),
    ("home_team", STR), ("away_team", STR), ("home_score", SMALL), ("away_score", SMALL),
    ("stage", STR), ("stadium", STR), ("referee", STR),
)
TEAMS = _struct(("team_id", INT), ("team_name", STR), ("country", STR))
PLAYERS = _struct(("player_id", INT), ("player_name", STR), ("nationality", STR), ("position", STR))
LEDGER = _struct(
    ("match_id", INT), ("competition_id", INT), ("event_count", LONG), ("status", STR), ("ingested_at", TS)
)
TEAM_XG_PARTIALS = _struct(("team_id", INT), ("match_id", INT), ("_shots", LONG), ("_goals", LONG), ("_xg", DBL))
REGISTRY = _struct(
    ("model_name", STR), ("version", STR), ("trained_at", TS), ("metrics", STR), ("artifact_path", STR)
)

_ID = _struct(("id", INT))
_NAME = _struct(("name", STR))
_POINT = _struct(("x", DBL), ("y", DBL))
_COORDS = T.ArrayType(DBL)

STATSBOMB_FEED = _struct(
    ("id", STR), ("minute", INT), ("second", INT), ("under_pressure", BOOL), ("type", _NAME), ("team", _ID),
    ("player", _ID), ("location", _COORDS),
    ("pass", _struct(("end_location", _COORDS), ("outcome", _NAME), ("recipient", _ID))),
    ("carry", _struct(("end_location", _COORDS))),
    ("shot", _struct(("end_location", _COORDS), ("outcome", _NAME), ("technique", _NAME), ("body_part", _NAME))),
    ("duel", _struct(("outcome", _NAME))),
)

OPTA_FEED = _struct(
    ("Events", T.ArrayType(_struct(
        ("EventId", LONG), ("TypeId", INT), ("Min", INT), ("Sec", INT), ("TeamId", INT), ("PlayerId", INT),
        ("Outcome", INT), ("X", DBL), ("Y", DBL), ("EndX", DBL), ("EndY", DBL),
        ("Qualifiers", T.ArrayType(_struct(("QualifierId", INT), ("Value", STR)))),
    ))),
)

WYSCOUT_FEED = _struct(
    ("events", T.ArrayType(_struct(
        ("id", LONG), ("minute", INT), ("second", INT),
        ("type", _struct(("primary", STR), ("secondary", T.ArrayType(STR)))),
        ("team", _ID), ("player", _ID), ("location", _POINT),
        ("pass", _struct(("accurate", BOOL), ("endLocation", _POINT), ("recipient", _ID))),
        ("shot", _struct(("isGoal", BOOL), ("onTarget", BOOL), ("endLocation", _POINT))),
        ("carry", _struct(("endLocation", _POINT))),
    ))),
)
