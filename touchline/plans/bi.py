"""BI datasets and dashboard panels.

Names are joined after the events were summed per id, so a join never sees more rows than there are ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions import coordinates as xy
from touchline.functions.labels import display_label
from touchline.functions.numeric import count_where, exact_avg, exact_sum, ratio, round_any, round_pos, to_units
from touchline.operators import joins, xt
from touchline.operators.running import order_by_abs, order_nulls_last
from touchline.operators.sequences import PRESS_TYPES

UNITS = 6


def _units(name: str) -> Column:
    return F.sum(to_units(F.col(name), UNITS))


def _total(name: str, digits: int) -> Column:
    return round_any(F.sum(name) / F.lit(10.0**UNITS), digits)


def bi_xt_grid(surface: DataFrame) -> DataFrame:
    return surface.select("grid_col", "grid_row", round_any(F.col("xt_value"), 4).alias("xt_value")).orderBy(
        "grid_row", "grid_col"
    )


def bi_xt_grid_normalised(surface: DataFrame) -> DataFrame:
    return xt.normalise_to_max(surface).orderBy("grid_row", "grid_col")


def bi_xt_thirds(surface: DataFrame) -> DataFrame:
    total = round_any(exact_sum(F.col("xt_value"), UNITS), 6).alias("total_xt")
    avg = round_any(exact_avg(F.col("xt_value"), UNITS), 4).alias("avg_xt")
    thirds = surface.groupBy(xy.pitch_third(F.col("grid_col")).alias("pitch_zone"))
    return thirds.agg(total, avg, F.count("*").alias("cell_count")).orderBy(F.desc("total_xt"))


def surface_coverage(surface: DataFrame) -> DataFrame:
    return surface.agg(
        F.count("*").alias("cells"), round_any(exact_avg(F.col("xt_value"), UNITS), 4).alias("avg_xt")
    )


def bi_player_xt(fact: DataFrame, players: DataFrame, n: int = 20) -> DataFrame:
    valued = fact.where(F.col("xt_value").isNotNull())
    per_id = valued.groupBy("player_id").agg(_units("xt_value").alias("_u"), F.count("*").alias("_n"))
    named = joins.add_inner(per_id, players.select("player_id", "player_name"), "player_id")
    by_name = named.groupBy("player_name").agg(_total("_u", 2).alias("total_xt"), F.sum("_n").alias("actions"))
    return by_name.orderBy(F.desc("total_xt"), "player_name").limit(n)


def bi_team_actions(fact: DataFrame, teams: DataFrame) -> DataFrame:
    c = F.col
    per_id = fact.where(c("xt_value").isNotNull()).groupBy("team_id").agg(
        _units("xt_value").alias("_u"), F.count("*").alias("_n"), count_where(c("event_type") == "Shot").alias("_s"),
        count_where(c("event_type") == "Pass").alias("_p"),
    )
    named = joins.add_inner(per_id, teams.select("team_id", "team_name"), "team_id")
    avg = round_any(F.sum("_u") / F.lit(10.0**UNITS) / F.sum("_n").cast("double"), 4)
    return named.groupBy("team_name").agg(
        F.sum("_n").alias("total_actions"), _total("_u", 2).alias("total_xt"), avg.alias("avg_xt"),
        F.sum("_s").alias("shots"), F.sum("_p").alias("passes"),
    ).orderBy(F.desc("total_xt"), "team_name")


def bi_zones(zones: DataFrame) -> DataFrame:
    return zones.select(
        "event_type", "cluster_label", round_pos(F.col("center_x"), 1).alias("x"),
        round_pos(F.col("center_y"), 1).alias("y"), "member_count",
    ).orderBy("event_type", "cluster_label")


def bi_shot_quality(fact: DataFrame) -> DataFrame:
    c = F.col
    shots = fact.where((c("event_type") == "Shot") & c("xg_value").isNotNull())
    zone = xy.shot_zone_boxes(c("location_x"), c("location_y")).alias("zone")
    avg = round_any(exact_avg(c("xg_value"), UNITS), 4).alias("avg_xg")
    return shots.groupBy(zone).agg(F.count("*").alias("shots"), avg).orderBy(F.desc("avg_xg"), "zone")


def bi_shot_xp_zone(fact: DataFrame) -> DataFrame:
    c = F.col
    shots = fact.where((c("event_type") == "Shot") & c("xp_value").isNotNull() & c("location_x").isNotNull())
    return shots.groupBy(xy.shot_zone_bands(c("location_x"), c("location_y")).alias("shot_zone")).agg(
        F.count("*").alias("total_shots"), round_any(exact_avg(c("xp_value"), UNITS), 3).alias("avg_xp"),
        round_any(exact_sum(c("xp_value"), UNITS), 2).alias("total_xp"),
    ).orderBy(F.desc("avg_xp"), "shot_zone")


def bi_match_balance(
    fact: DataFrame, matches: DataFrame, teams: DataFrame, detail: bool = False, n: int = 50
) -> DataFrame:
    """Home and away xT of the most one-sided matches; ``detail`` adds the match columns and a third digit."""
    c = F.col
    digits = 3 if detail else 2
    split = joins.home_away_split(fact.where(c("xt_value").isNotNull()), matches, teams, "xt_value", UNITS)
    diff = "xt_difference" if detail else "xt_diff"
    out = split.select(
        "match_id", round_any(c("home"), digits).alias("home_xt"), round_any(c("away"), digits).alias("away_xt"),
        round_any(c("home") - c("away"), digits).alias(diff),
    )
    if detail:
        heads = matches.select("match_id", "match_date", "home_team", "away_team", "home_score", "away_score")
        out = heads.join(out, "match_id")
    return order_by_abs(out, diff, "match_id").limit(n)


def bi_pressure_by_team(fact: DataFrame, teams: DataFrame, n: int = 20) -> DataFrame:
    pressed = fact.where(F.col("under_pressure")).groupBy("team_id").agg(
        F.count("*").alias("_n"), F.sum("minute").alias("_m"), F.count("minute").alias("_k")
    )
    named = joins.add_inner(pressed, teams.select("team_id", "team_name"), "team_id")
    return named.groupBy("team_name").agg(
        F.sum("_n").alias("press_count"), round_pos(ratio(F.sum("_m"), F.sum("_k")), 1).alias("avg_minute")
    ).orderBy(F.desc("press_count"), "team_name").limit(n)


def bi_press_per_match(fact: DataFrame, teams: DataFrame, n: int = 20) -> DataFrame:
    """Pressing actions per match played, in whole numbers."""
    c = F.col
    actions = fact.where(c("event_type").isin(*PRESS_TYPES)).groupBy("team_id", "match_id").agg(F.count("*").alias("_n"))
    named = joins.add_inner(actions, teams.select("team_id", "team_name"), "team_id")
    per_match = named.groupBy("team_name", "match_id").agg(F.sum("_n").alias("_n"))
    total = F.sum("_n")
    return per_match.groupBy("team_name").agg(
        total.alias("total_press_actions"), F.count("match_id").alias("matches_played"),
        F.call_function("div", total, F.count("match_id")).cast("double").alias("press_per_match"),
    ).orderBy(F.desc("press_per_match"), "team_name").limit(n)


def bi_competitions(fact: DataFrame, matches: DataFrame, competitions: DataFrame) -> DataFrame:
    """xT per competition. Summed per match first, so matches are counted and not distinct-counted."""
    per_match = fact.where(F.col("xt_value").isNotNull()).groupBy("match_id").agg(
        _units("xt_value").alias("_u"), F.count("*").alias("_n")
    )
    known = joins.with_competition(matches.select("match_id", "competition_id"), competitions)
    joined = joins.add_inner(per_match, known, "match_id")
    xt_sum = F.sum("_u") / F.lit(10.0**UNITS)
    return joined.groupBy("competition_name").agg(
        F.count("*").alias("total_matches"), round_any(xt_sum, 2).alias("total_xt"),
        round_any(xt_sum / F.sum("_n").cast("double"), 5).alias("avg_xt_per_event"),
        round_any(xt_sum / F.count("*").cast("double"), 3).alias("avg_xt_per_match"),
    ).orderBy(F.desc("avg_xt_per_match"), "competition_name")


def bi_player_mart(player_metrics: DataFrame, n: int = 20) -> DataFrame:
    best = player_metrics.where(F.col("total_xt").isNotNull()).orderBy(F.desc("total_xt"), "player_id", "team_name")
    return best.limit(n).select(
        "player_name", "team_name", "total_passes", "successful_passes", "pass_completion_pct", "avg_pass_distance_m",
        "total_xt", "avg_xt_per_pass", "passes_under_pressure",
    )


def bi_team_mart(team_summary: DataFrame) -> DataFrame:
    cols = ("team_name", "total_actions", "total_passes", "total_shots", "total_dribbles", "total_pressures", "total_xt")
    return order_nulls_last(team_summary, "total_xt", "team_name").select(*cols)


def bi_matches_by_comp(matches: DataFrame, competitions: DataFrame, n: int = 15) -> DataFrame:
    joined = joins.with_competition(matches, competitions)
    counted = joined.groupBy("competition_name").agg(F.count("match_id").alias("matches"))
    return counted.orderBy(F.desc("matches"), "competition_name").limit(n)


def events_by_type(fact: DataFrame, n: int = 10) -> DataFrame:
    counted = fact.groupBy("event_type").agg(F.count("*").alias("count"))
    return counted.orderBy(F.desc("count"), "event_type").limit(n)


def ingest_per_day(ledger: DataFrame) -> DataFrame:
    day = F.to_date("ingested_at").alias("time")
    return ledger.groupBy(day).agg(F.count("*").alias("matches")).orderBy("time")


def bi_team_xg(team_xg: DataFrame, n: int = 20) -> DataFrame:
    """Largest xG rows of the team view; rows without xG come first, as in a plain descending order there."""
    ordered = team_xg.orderBy(F.desc_nulls_first("total_xg"), "team_name", "match_id").limit(n)
    return ordered.select("team_name", "match_id", "total_shots", "total_xg", "goals_scored", "conversion_rate")


def bi_player_xp(player_metrics: DataFrame, n: int = 20, min_passes: int = 50) -> DataFrame:
    c = F.col
    kept = player_metrics.where(c("avg_xp").isNotNull() & (c("total_passes") >= min_passes))
    best = kept.orderBy(F.desc("avg_xp"), "player_id", "team_name").limit(n)
    return best.select(
        "player_name", "team_name", "avg_xp", "total_passes", "pass_completion_pct",
        display_label(c("player_name"), c("team_name")).alias("label"),
    )


def bi_shot_points(shots: DataFrame, n: int = 4000) -> DataFrame:
    """Shot points with xG, a fixed number of them. ``shots`` carries xg_value."""
    kept = shots.where(F.col("xg_value").isNotNull())
    return kept.select("event_id", "location_x", "location_y", "is_goal", "xg_value").orderBy("event_id").limit(n)
