"""Bronze, silver and staging layers: row-wise work in one scan, no shuffle.

Silver can carry model values and the competition along (``keep``). The marts then read one table instead of
joining the events back to the fact table on their id, which would shuffle the two largest inputs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions import coordinates as xy
from touchline.functions.numeric import round_any, round_pos

VALUE_COLUMNS = ("competition_id", "xt_value", "xg_value", "xp_value")
# Fixed value: providers whose payload names the receiver of a pass.
RECIPIENT_PROVIDERS = ("statsbomb", "wyscout")
SHOT_PAYLOAD = "shot struct<technique:struct<name:string>, body_part:struct<name:string>>, Qualifiers array<struct<QualifierId:int>>"


def bronze_events(fact: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Typed pass-through; rows without an id are dropped."""
    c = F.col
    return fact.where(c("event_id").isNotNull()).select(
        c("event_id").cast("string").alias("event_id"),
        *[c(name).cast("int").alias(name) for name in ("match_id", "team_id", "player_id")],
        c("event_type").cast("string").alias("event_type"),
        *[c(name).cast("int").alias(name) for name in ("minute", "second")],
        *[c(name).cast("double").alias(name)
          for name in ("location_x", "location_y", "end_location_x", "end_location_y")],
        c("outcome").cast("string").alias("outcome"),
        c("under_pressure").cast("boolean").alias("under_pressure"),
        c("provider").cast("string").alias("provider"), c("coord_system").cast("string").alias("coord_system"),
        c("raw_json").cast("string").alias("raw_json"),
        F.coalesce("ingested_at", F.current_timestamp().cast(fact.schema["ingested_at"].dataType))
        .alias("ingested_at"),
        *keep,
    )


def silver_events(bronze: DataFrame, keep: Sequence[str] = (), null_safe: bool = False) -> DataFrame:
    """Events on the common pitch, clamped and rounded to millimetres.

    A missing end point becomes the corner (0, 0), as the null-skipping clamp does; ``null_safe`` keeps it null.
    """
    c = F.col

    def on_pitch(name: str, scaled: Column, high: float) -> Column:
        value = round_pos(xy.clamp(scaled, 0.0, high, null_safe), 3)
        # Never null here; saying so lets the optimizer drop the null checks of later layers instead of
        # computing the coordinate once more to test it.
        return (value if null_safe else F.coalesce(value, F.lit(0.0))).alias(name)

    def x(name: str) -> Column:
        return on_pitch(name, xy.normalise_x(c(name), c("coord_system")), xy.PITCH_X)

    def y(name: str) -> Column:
        return on_pitch(name, xy.normalise_y(c(name), c("coord_system")), xy.PITCH_Y)

    placed = c("location_x").isNotNull() & c("location_y").isNotNull()
    return bronze.where(c("event_id").isNotNull() & c("match_id").isNotNull() & placed).select(
        "event_id", "match_id", "team_id", "player_id", "event_type", "minute", "second", "provider", "coord_system",
        x("location_x"), y("location_y"), x("end_location_x"), y("end_location_y"),
        F.coalesce("outcome", F.lit("Unknown")).alias("outcome"),
        F.coalesce("under_pressure", F.lit(False)).alias("under_pressure"),
        "raw_json", "ingested_at", *keep,
    )


def enriched_events(fact: DataFrame, null_safe: bool = False) -> DataFrame:
    """Silver events with their competition and model values on the same row."""
    return silver_events(bronze_events(fact, VALUE_COLUMNS), VALUE_COLUMNS, null_safe)


def completed_pass(strict: bool = False) -> Column:
    """The words of a completed pass."""
    return F.col("outcome").isin("Unknown", "Success") if strict else F.col("outcome") == "Unknown"


def silver_passes(events: DataFrame, keep: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """Passes with their length in metres. ``strict`` also accepts the third feed's word for a completed pass."""
    c = F.col
    done = completed_pass(strict)
    length = xy.distance(c("location_x"), c("location_y"), c("end_location_x"), c("end_location_y"))
    placed = c("location_x").isNotNull() & c("end_location_x").isNotNull()
    return events.where((c("event_type") == "Pass") & placed).select(
        "event_id", "match_id", "team_id", "player_id", "minute", "second", "location_x", "location_y",
        "end_location_x", "end_location_y", "under_pressure", "provider", "outcome",
        round_pos(length, 2).alias("pass_distance_m"), done.alias("is_successful"), *keep,
    )


def silver_shots(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Shots with distance, visible angle, header flag, body part and the goal flag."""
    c = F.col
    # One pass over the payload for all that a shot needs of it.
    payload = F.from_json("raw_json", SHOT_PAYLOAD)
    tagged = F.exists(c("_payload.Qualifiers"), lambda q: q["QualifierId"] == 72)
    header = ((c("provider") == "statsbomb") & (c("_payload.shot.technique.name") == "Header")) | (
        (c("provider") == "opta") & tagged
    )
    body_part = F.when(
        c("provider") == "statsbomb", F.coalesce("_payload.shot.body_part.name", F.lit("Unknown"))
    ).otherwise("Unknown")
    placed = c("location_x").isNotNull() & c("location_y").isNotNull()
    shots = events.where((c("event_type") == "Shot") & placed).withColumn("_payload", payload)
    return shots.select(
        "event_id", "match_id", "team_id", "player_id", "minute", "second", "location_x", "location_y", "outcome",
        "under_pressure", "provider", "raw_json",
        # Never null for a placed shot; the default only tells the optimizer so.
        F.coalesce(round_pos(xy.goal_distance(c("location_x"), c("location_y")), 3), F.lit(0.0)).alias("distance_to_goal"),
        F.coalesce(round_pos(xy.goal_angle(c("location_x"), c("location_y")), 5), F.lit(0.0)).alias("shot_angle"),
        F.coalesce(header, F.lit(False)).alias("is_header"), body_part.alias("body_part"),
        F.when(c("outcome") == "Goal", 1).otherwise(0).alias("is_goal"), *keep,
    )


def silver_pass_links(events: DataFrame) -> DataFrame:
    """Passes with passer and, where the payload names one, receiver. The payload is on the silver row already."""
    c = F.col
    receiver = F.get_json_object("raw_json", "$.pass.recipient.id").try_cast("int")
    return silver_passes(events, keep=("raw_json",)).where(c("player_id").isNotNull()).select(
        "event_id", "match_id", "team_id", c("player_id").alias("from_player_id"),
        F.when(c("provider").isin(*RECIPIENT_PROVIDERS), receiver).alias("to_player_id"),
        "pass_distance_m", "is_successful", "under_pressure", "location_x", "location_y", "end_location_x",
        "end_location_y",
    )


def stg_events(fact: DataFrame) -> DataFrame:
    """Older staging view in native units."""
    c = F.col
    kept = c("location_x").isNotNull() & c("location_y").isNotNull() & c("event_type").isNotNull()
    return fact.where(kept).select(
        c("event_id").cast("string").alias("event_id"),
        *[c(name).cast("int").alias(name) for name in ("match_id", "competition_id", "team_id", "player_id")],
        "event_type", c("minute").cast("smallint").alias("minute"),
        F.coalesce("second", F.lit(0)).cast("smallint").alias("second"),
        *[round_any(c(name), 2).alias(name)
          for name in ("location_x", "location_y", "end_location_x", "end_location_y")],
        "outcome", F.coalesce("under_pressure", F.lit(False)).alias("under_pressure"),
        "xt_value", "xp_value", "xg_value",
    )


def stg_passes(staged: DataFrame) -> DataFrame:
    c = F.col
    length = xy.distance(c("location_x"), c("location_y"), c("end_location_x"), c("end_location_y"))
    ended = c("end_location_x").isNotNull() & c("end_location_y").isNotNull()
    return staged.where((c("event_type") == "Pass") & ended).select(
        "event_id", "match_id", "competition_id", "team_id", "player_id", "minute", "second", "location_x",
        "location_y", "end_location_x", "end_location_y",
        F.when(c("outcome").isNull(), 1).otherwise(0).alias("is_successful"), "under_pressure", "xt_value",
        "xp_value", round_pos(length, 2).alias("pass_distance"),
    )


def stg_shots(staged: DataFrame) -> DataFrame:
    c = F.col
    return staged.where(c("event_type") == "Shot").select(
        "event_id", "match_id", "competition_id", "team_id", "player_id", "minute", "second", "location_x",
        "location_y", "end_location_x", "end_location_y", "outcome", "under_pressure", "xt_value", "xg_value",
        F.when(c("outcome") == "Goal", 1).otherwise(0).alias("is_goal"),
    )
