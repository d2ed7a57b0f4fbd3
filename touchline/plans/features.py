"""Model inputs: pass features, shot features, player profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions import coordinates as xy
from touchline.functions.numeric import count_where, exact_avg, ratio, round_any
from touchline.plans import silver

XP_FEATURES = (
    "start_x_n", "start_y_n", "end_x_n", "end_y_n", "distance", "angle_to_goal", "under_pressure", "minute_bin",
)
XG_FEATURES = ("distance_to_goal", "shot_angle", "under_pressure", "is_header", "body_part_encoded")
PLAYER_FEATURES = (
    "shots_per_match", "goals_per_match", "avg_shot_distance", "avg_shot_angle", "header_ratio", "xg_per_shot",
    "passes_per_match", "pass_completion_rate", "avg_pass_distance_m", "avg_location_x", "avg_location_y",
    "under_pressure_ratio",
)
MIN_MATCHES = 3


def xp_features(passes: DataFrame) -> DataFrame:
    """Eight pass features and the target; the angle is between the pass and the way to the goal centre."""
    c = F.col
    dx, dy = c("end_location_x") - c("location_x"), c("end_location_y") - c("location_y")
    gx, gy = F.lit(xy.GOAL_X) - c("location_x"), F.lit(xy.GOAL_Y) - c("location_y")
    lengths = F.sqrt(dx * dx + dy * dy) * F.sqrt(gx * gx + gy * gy)
    cosine = F.try_divide(dx * gx + dy * gy, lengths)
    angle = F.coalesce(F.acos(F.least(F.greatest(cosine, F.lit(-1.0)), F.lit(1.0))), F.lit(0.0))
    no_angle = (lengths == 0) | lengths.isNull()
    # Bins are closed on the right: up to 45, up to 90, beyond. Other minutes are an input error.
    phase = F.when(c("minute").between(0, 45), 0).when(c("minute").between(46, 90), 1).when(
        c("minute").between(91, 999), 2
    )
    checked = F.when(phase.isNotNull(), phase).otherwise(F.raise_error(F.lit("minute outside 0..999")).cast("int"))
    return passes.select(
        "event_id", (c("location_x") / xy.PITCH_X).alias("start_x_n"), (c("location_y") / xy.PITCH_Y).alias("start_y_n"),
        (c("end_location_x") / xy.PITCH_X).alias("end_x_n"), (c("end_location_y") / xy.PITCH_Y).alias("end_y_n"),
        (F.sqrt(dx * dx + dy * dy) / xy.PITCH_X).alias("distance"),
        F.when(no_angle, 0.0).otherwise(angle).alias("angle_to_goal"),
        c("under_pressure").cast("int").alias("under_pressure"), checked.alias("minute_bin"),
        (c("outcome") == "Unknown").cast("int").alias("target"),
    )


def body_part_index(shots: DataFrame) -> DataFrame:
    """Body part names numbered from 0 in alphabetical order (a handful of rows)."""
    names = shots.select(F.coalesce("body_part", F.lit("Unknown")).alias("body_part")).distinct()
    ordered = names.agg(F.array_sort(F.collect_set("body_part")).alias("names"))
    return ordered.select(F.posexplode("names").alias("body_part_encoded", "body_part"))


def xg_features(shots: DataFrame) -> DataFrame:
    """Five shot features and the goal flag.

    The index of body parts has one row per distinct name; the feed uses a fixed handful of them.
    """
    c = F.col
    rows = shots.select(
        "event_id", "distance_to_goal", "shot_angle", c("under_pressure").cast("int").alias("under_pressure"),
        c("is_header").cast("int").alias("is_header"), F.coalesce("body_part", F.lit("Unknown")).alias("body_part"),
        "is_goal",
    ).where(c("distance_to_goal").isNotNull() & c("shot_angle").isNotNull())
    return rows.join(body_part_index(rows), "body_part").select("event_id", *XG_FEATURES, "body_part", "is_goal")


def player_feature_join(players: DataFrame, shots: DataFrame, passes: DataFrame, min_matches: int) -> DataFrame:
    """Players with enough matches, with their shot and pass aggregates."""
    busy = passes.where(F.col("matches_played") >= min_matches)
    return players.join(busy, "player_id").join(shots, "player_id", "left")


def player_features(
    events: DataFrame, players: DataFrame, min_matches: int = MIN_MATCHES, digits: int | None = None
) -> DataFrame:
    """Twelve profile features per player. ``events`` is :func:`silver.enriched_events`.

    Every aggregate first sums per (player, match), which turns the distinct match count into a plain count.
    """
    c = F.col
    # Where a player without passes is placed.
    home_x, home_y = 52.5, 34.0
    passes = silver.silver_passes(events).where(c("player_id").isNotNull())
    pass_agg = _per_match(
        passes,
        {"total_passes": F.count("*"), "_done": count_where(c("is_successful")),
         "_pressed": count_where(c("under_pressure")), "_length": _units("pass_distance_m", 2),
         "_x": _units("location_x", 3), "_y": _units("location_y", 3)},
    ).withColumnRenamed("_matches", "matches_played")
    shots = silver.silver_shots(events, keep=("xg_value",)).where(c("player_id").isNotNull())
    shot_agg = shots.groupBy("player_id").agg(
        F.count("*").alias("total_shots"), F.sum("is_goal").alias("goals"),
        exact_avg(c("distance_to_goal"), 3).alias("_shot_distance"), exact_avg(c("shot_angle"), 5).alias("_shot_angle"),
        ratio(count_where(c("is_header")), F.count("*")).alias("_headers"), exact_avg(c("xg_value"), 6).alias("_xg"),
    )
    joined = player_feature_join(players, shot_agg, pass_agg, min_matches)

    def or_(value, default: float):
        return F.coalesce(value, F.lit(default))

    def mean(name: str, digits_: int):
        return ratio(c(name) / F.lit(10.0**digits_), c("total_passes"))

    features = {
        "shots_per_match": ratio(or_(c("total_shots"), 0), c("matches_played")),
        "goals_per_match": ratio(or_(c("goals"), 0), c("matches_played")),
        "avg_shot_distance": or_(c("_shot_distance"), 0.0), "avg_shot_angle": or_(c("_shot_angle"), 0.0),
        "header_ratio": or_(c("_headers"), 0.0), "xg_per_shot": or_(c("_xg"), 0.0),
        "passes_per_match": ratio(c("total_passes"), c("matches_played")),
        "pass_completion_rate": ratio(c("_done"), c("total_passes")),
        "avg_pass_distance_m": mean("_length", 2), "avg_location_x": or_(mean("_x", 3), home_x),
        "avg_location_y": or_(mean("_y", 3), home_y), "under_pressure_ratio": ratio(c("_pressed"), c("total_passes")),
    }
    out = {name: round_any(value, digits) if digits else value for name, value in features.items()}
    return joined.select("player_id", "player_name", "position", *[v.alias(k) for k, v in out.items()])


def _units(name: str, digits: int):
    return F.sum(F.floor(F.col(name) * F.lit(10.0**digits) + F.lit(0.5)))


def _per_match(rows: DataFrame, sums: dict) -> DataFrame:
    per_match = rows.groupBy("player_id", "match_id").agg(*[value.alias(name) for name, value in sums.items()])
    return per_match.groupBy("player_id").agg(
        *[F.sum(name).alias(name) for name in sums], F.count("match_id").alias("_matches")
    )


