"""Gold layer and the stored views. ``events`` is always :func:`silver.enriched_events`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions import coordinates as xy
from touchline.functions.numeric import count_where, exact_avg, exact_sum, ratio, round_any, round_pos
from touchline.operators import joins
from touchline.plans import silver

XT_DIGITS = 6


def _or_zero(name: str):
    return F.coalesce(F.col(name), F.lit(0.0))


def value_sum(name: str, digits: int = 4):
    """Sum of a model value, missing values counting as zero."""
    return round_any(exact_sum(_or_zero(name), XT_DIGITS), digits)


def value_avg(name: str, digits: int = 4):
    """Mean of a model value over the rows that have one."""
    return round_any(exact_avg(F.col(name), XT_DIGITS), digits)


def gold_player_metrics(events: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    """Passing and shooting per player, team and match: one scan and one aggregation by player, team and match.

    A player's passes and shots in a match meet by player and match, whatever their team, as a full outer join does:
    each team with passes meets each team with shots. The teams of a player in a match are a handful, so they are
    paired within the group. Without a player nothing meets, and every team stands alone.
    """
    c = F.col
    is_pass = (c("event_type") == "Pass") & c("location_x").isNotNull() & c("end_location_x").isNotNull()
    is_shot = (c("event_type") == "Shot") & c("location_x").isNotNull() & c("location_y").isNotNull()
    rows = events.where(c("event_type").isin("Pass", "Shot")).withColumns({
        "is_successful": silver.completed_pass(),
        "pass_distance_m": round_pos(xy.distance(c("location_x"), c("location_y"), c("end_location_x"), c("end_location_y")), 2),
    })

    def sum_of(name: str, where):
        return round_any(exact_sum(F.when(where, F.coalesce(c(name), F.lit(0.0))), XT_DIGITS), 4)

    both = rows.groupBy("player_id", "match_id", "team_id").agg(
        count_where(is_pass).alias("_passes"), count_where(is_pass & c("is_successful")).alias("_done"),
        round_pos(exact_avg(F.when(is_pass, c("pass_distance_m")), 2), 2).alias("avg_pass_distance_m"),
        sum_of("xt_value", is_pass).alias("_xt"), count_where(is_pass & c("under_pressure")).alias("_pressed"),
        count_where(is_shot).alias("_shots"), sum_of("xg_value", is_shot).alias("_xg"),
        count_where(is_shot & (c("outcome") == "Goal")).alias("_goals"),
    )
    merged = _paired(both)
    merged = joins.add_player_name(merged, players)
    merged = joins.join_dims_on(
        merged, F.coalesce("_pass_team", "_shot_team"), teams, "team_id", {"team_name": "team_name"}
    )

    def count(name: str):
        return F.coalesce(name, F.lit(0))

    return merged.select(
        "player_id", "player_name", "team_name", "match_id",
        count("_passes").alias("total_passes"), count("_done").alias("successful_passes"),
        round_pos(ratio(count("_done") * 100.0, count("_passes")), 2).alias("pass_completion_pct"),
        "avg_pass_distance_m", _or_zero("_xt").alias("total_xt"),
        count("_pressed").alias("passes_under_pressure"), count("_shots").alias("total_shots"),
        _or_zero("_xg").alias("total_xg"), count("_goals").alias("goals"),
    )


_PASSING = ("_passes", "_done", "avg_pass_distance_m", "_xt", "_pressed")
_SHOOTING = ("_shots", "_xg", "_goals")


def _paired(both: DataFrame) -> DataFrame:
    """Sides of a (player, match) paired as a full outer join on player and match pairs them; a null player never."""
    c = F.col
    side = F.struct("team_id", *_PASSING, *_SHOOTING)
    alone = F.when(c("player_id").isNull(), F.struct("team_id"))  # one group for each team without a player
    # The teams a player has events for in one match: one, rarely two.
    group = both.groupBy("player_id", "match_id", alone.alias("_alone")).agg(F.collect_list(side).alias("_sides"))
    passing = F.filter("_sides", lambda s: s["_passes"] > 0)
    shooting = F.filter("_sides", lambda s: s["_shots"] > 0)
    none = F.array(F.lit(None).cast(both.select(side.alias("s")).schema["s"].dataType))

    def or_none(sides):
        return F.when(F.size(sides) > 0, sides).otherwise(none)

    met = group.where(c("player_id").isNotNull()).select("player_id", "match_id", or_none(passing).alias("_p"), or_none(shooting).alias("_s"))
    met = met.withColumn("_p", F.explode("_p")).withColumn("_s", F.explode("_s"))
    single = group.where(c("player_id").isNull()).withColumn("_side", F.explode("_sides"))
    empty = F.lit(None).cast(both.select(side.alias("s")).schema["s"].dataType)
    halves = F.array(
        F.struct(F.when(c("_side._passes") > 0, c("_side")).otherwise(empty).alias("_p"), empty.alias("_s")),
        F.struct(empty.alias("_p"), F.when(c("_side._shots") > 0, c("_side")).otherwise(empty).alias("_s")),
    )
    single = single.select("player_id", "match_id", F.explode(halves).alias("_h")).select("player_id", "match_id", "_h.*")
    every = met.unionByName(single).where(c("_p").isNotNull() | c("_s").isNotNull())
    return every.select(
        "player_id", "match_id", c("_p.team_id").alias("_pass_team"), c("_s.team_id").alias("_shot_team"),
        *[c(f"_p.{name}").alias(name) for name in _PASSING], *[c(f"_s.{name}").alias(name) for name in _SHOOTING],
    )


def gold_team_summary(events: DataFrame, teams: DataFrame) -> DataFrame:
    """Counts, goals, xG, xT and conversion per team and match."""
    c = F.col
    goals, shots = count_where(c("outcome") == "Goal"), count_where(c("event_type") == "Shot")
    agg = (
        events.where(c("team_id").isNotNull())
        .groupBy("team_id", "match_id")
        .agg(
            F.count("*").alias("total_actions"), count_where(c("event_type") == "Pass").alias("total_passes"),
            shots.alias("total_shots"), goals.alias("goals"),
            value_sum("xg_value").alias("total_xg"), value_sum("xt_value").alias("total_xt"),
            round_pos(ratio(goals, shots), 4).alias("conversion_rate"),
        )
    )
    return joins.add_team_name(agg, teams)


def gold_xt_grid(events: DataFrame) -> DataFrame:
    """xT of passes per start cell. The far edges are not folded in: x = 105 lands in column 16."""
    c = F.col
    passes = silver.silver_passes(events, keep=("xt_value",)).where(c("xt_value").isNotNull())
    return (
        passes.groupBy(
            xy.grid_col(c("location_x"), clamped=False).alias("grid_col"),
            xy.grid_row(c("location_y"), clamped=False).alias("grid_row"),
        )
        .agg(
            F.count("*").alias("pass_count"), value_sum("xt_value").alias("total_xt"),
            value_avg("xt_value").alias("avg_xt"), round_any(F.max("xt_value"), 4).alias("max_xt"),
        )
        .orderBy(F.desc("total_xt"), "grid_col", "grid_row")
    )


def gold_shot_map(events: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    """Shots with names and xG for a scatter plot."""
    named = joins.add_names(silver.silver_shots(events, keep=("xg_value",)).drop("raw_json"), players, teams)
    return named.select(
        "event_id", "match_id", "player_id", "team_id", "player_name", "team_name",
        F.col("location_x").alias("x_105"), F.col("location_y").alias("y_68"), "distance_to_goal", "shot_angle",
        "is_header", "body_part", "is_goal", "xg_value", "under_pressure", "minute", "provider",
    )


def mv_team_xg(fact: DataFrame, teams: DataFrame) -> DataFrame:
    """Shots, xG and goals per team name and match, from native events.

    Shots are summed per team id first; the names are joined to the sums, then merged where names coincide.
    """
    return team_xg_of(team_xg_partials(fact), teams)


def team_xg_partials(fact: DataFrame) -> DataFrame:
    """Sums per team id and match that add up across any split of the events."""
    c = F.col
    return (
        fact.where(c("event_type") == "Shot")
        .groupBy("team_id", "match_id")
        .agg(
            F.count("*").alias("_shots"), count_where(c("outcome") == "Goal").alias("_goals"),
            exact_sum(c("xg_value"), XT_DIGITS).alias("_xg"),
        )
    )


def team_xg_of(partials: DataFrame, teams: DataFrame) -> DataFrame:
    """The view from its partial sums."""
    c = F.col
    named = joins.add_team_name(partials, teams).withColumn("team_name", F.coalesce("team_name", F.lit("Unknown")))
    total, goals = F.sum("_shots"), F.sum("_goals")
    return named.groupBy("team_name", "match_id").agg(
        total.alias("total_shots"), round_any(exact_sum(c("_xg"), XT_DIGITS), 4).alias("total_xg"),
        goals.alias("goals_scored"), round_pos(ratio(goals, total), 4).alias("conversion_rate"),
    )


def mv_shot_locations(fact: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    """Shot points on the common pitch, not clamped."""
    c = F.col
    known = c("coord_system").isin(*xy.NATIVE_SIZE)

    def point(name: str, scaled):
        return F.when(known, round_any(scaled, 3)).otherwise(c(name))

    named = joins.add_names(fact.where(c("event_type") == "Shot"), players, teams)
    return named.select(
        "event_id", "match_id", "player_name", F.coalesce("team_name", F.lit("Unknown")).alias("team_name"),
        point("location_x", xy.normalise_x(c("location_x"), c("coord_system"))).alias("x_norm"),
        point("location_y", xy.normalise_y(c("location_y"), c("coord_system"))).alias("y_norm"),
        "xg_value", "outcome", "under_pressure", "minute",
    )
