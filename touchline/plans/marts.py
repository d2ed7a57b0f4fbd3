"""Marts. ``events`` is :func:`silver.enriched_events` unless stated."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.coordinates import distance
from touchline.functions.labels import pressing_label
from touchline.functions.numeric import count_where, exact_avg, ratio, round_any, round_pos, to_units
from touchline.operators import joins
from touchline.operators.running import rank_rows
from touchline.plans.gold import value_avg, value_sum

# Event types that count as defensive actions, and the smallest pass count of an edge.
DEFENSIVE_TYPES = ("Tackle", "Interception", "Foul", "Block", "Pressure")
MIN_EDGE_PASSES = 2
HIGH_XT = 0.05


def _type_count(name: str):
    return count_where(F.col("event_type") == name)


def mart_player_metrics(events: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    """Passing, shooting and xT per player and team in one scan and one shuffle.

    Passes, shots and all events of a (player, team) come from a single aggregate instead of three aggregates
    and two joins. A null team never matches itself in those joins, so its pass part and its shot part are
    separate rows there and total xT stays null; ``part`` reproduces that.
    """
    c = F.col
    is_pass, is_shot = c("event_type") == "Pass", c("event_type") == "Shot"
    length = F.when(is_pass, _pass_length())
    placed = events.where(c("player_id").isNotNull()).select(
        "player_id", "team_id", "xt_value", "xg_value", "xp_value", "outcome", "under_pressure",
        (is_pass & c("end_location_x").isNotNull()).alias("_pass"), is_shot.alias("_shot"), length.alias("_length"),
    )

    def only(flag: str, value):
        return F.when(c(flag), value)

    xt = F.coalesce("xt_value", F.lit(0.0))
    units = 6

    def total(value):
        return round_any(F.sum(to_units(value, units)) / F.lit(10.0**units), 4)

    def mean(value, digits=4):
        return round_any(exact_avg(value, units), digits)

    n_pass, n_shot = count_where(c("_pass")), count_where(c("_shot"))
    done = count_where(c("_pass") & (c("outcome") == "Unknown"))
    agg = placed.groupBy("player_id", "team_id").agg(
        n_pass.alias("_n_pass"), done.alias("_done"), n_shot.alias("_n_shot"),
        count_where(c("_shot") & (c("outcome") == "Goal")).alias("_goals"),
        round_pos(exact_avg(only("_pass", c("_length")), 2), 2).alias("_avg_length"),
        count_where(c("_pass") & c("under_pressure")).alias("_pressed"),
        mean(only("_pass", c("xp_value"))).alias("_avg_xp"),
        total(only("_shot", xt)).alias("_xt_shots"),
        total(only("_shot", F.coalesce("xg_value", F.lit(0.0)))).alias("_xg"),
        mean(only("_shot", c("xg_value"))).alias("_avg_xg"), total(xt).alias("_xt_all"),
        round_any(exact_avg(only("_pass", xt), units), 6).alias("_xt_per_pass"),
    )
    split = F.filter(
        F.array(F.when(c("_n_pass") > 0, F.lit("pass")), F.when(c("_n_shot") > 0, F.lit("shot"))),
        lambda part: part.isNotNull(),
    )
    whole = F.when((c("_n_pass") > 0) | (c("_n_shot") > 0), F.array(F.lit("both"))).otherwise(
        F.array().cast("array<string>")
    )
    rows = agg.withColumn("_part", F.explode(F.when(c("team_id").isNull(), split).otherwise(whole)))
    has_pass = (c("_part") != "shot") & (c("_n_pass") > 0)
    has_shot = (c("_part") != "pass") & (c("_n_shot") > 0)

    def p(name: str, empty=None):
        value = F.when(has_pass, c(name))
        return value if empty is None else F.coalesce(value, F.lit(empty))

    def s(name: str, empty=None):
        value = F.when(has_shot, c(name))
        return value if empty is None else F.coalesce(value, F.lit(empty))

    named = joins.add_names(rows, players, teams)
    pct = round_pos(round_pos(ratio(c("_done"), c("_n_pass")), 8) * 100.0, 1)
    return named.select(
        "player_id", "player_name", "team_name",
        p("_n_pass", 0).alias("total_passes"), p("_done", 0).alias("successful_passes"),
        F.when(has_pass, pct).alias("pass_completion_pct"), p("_avg_length").alias("avg_pass_distance_m"),
        p("_pressed", 0).alias("passes_under_pressure"), p("_avg_xp").alias("avg_xp"),
        s("_n_shot", 0).alias("total_shots"), s("_goals", 0).alias("goals"),
        s("_xt_shots", 0.0).alias("total_xt_shots"), s("_xg", 0.0).alias("total_xg"),
        s("_avg_xg").alias("avg_xg"),
        round_any(s("_goals", 0) - s("_xg", 0.0), 4).alias("finishing_quality"),
        F.when(c("team_id").isNotNull(), c("_xt_all")).alias("total_xt"), p("_xt_per_pass").alias("avg_xt_per_pass"),
    )


def _pass_length():
    c = F.col
    return round_pos(distance(c("location_x"), c("location_y"), c("end_location_x"), c("end_location_y")), 2)


def mart_team_summary(events: DataFrame, teams: DataFrame) -> DataFrame:
    agg = (
        events.where(F.col("team_id").isNotNull())
        .groupBy("team_id")
        .agg(
            F.count("*").alias("total_actions"), _type_count("Pass").alias("total_passes"),
            _type_count("Shot").alias("total_shots"), _type_count("Dribble").alias("total_dribbles"),
            _type_count("Pressure").alias("total_pressures"), _type_count("Carry").alias("total_carries"),
            value_sum("xt_value").alias("total_xt"), value_avg("xp_value").alias("avg_xp"),
            value_sum("xg_value").alias("total_xg"),
        )
    )
    return joins.add_team_name(agg, teams)


def mart_match_summary(events: DataFrame, matches: DataFrame) -> DataFrame:
    """Scoreline and volumes per match; matches without events are kept."""
    agg = events.groupBy("match_id").agg(
        F.count("*").alias("total_events"), _type_count("Shot").alias("total_shots"),
        _type_count("Pass").alias("total_passes"), _type_count("Pressure").alias("total_pressures"),
        value_sum("xt_value").alias("total_xt"), count_where(F.col("xt_value") > HIGH_XT).alias("high_xt_actions"),
        value_sum("xg_value").alias("total_xg"),
    )
    heads = matches.select("match_id", "match_date", "home_team", "away_team", "home_score", "away_score", "stage")
    return joins.matches_with_aggregates(heads, agg)


def competition_totals(events: DataFrame) -> DataFrame:
    """Player totals per competition.

    Summed per match first: that shrinks the data inside each task, and the number of matches becomes a plain
    count instead of a distinct one.
    """
    c = F.col
    values = {"xt_value": "_xt", "xg_value": "_xg", "xp_value": "_xp"}
    per_match = (
        events.where(c("player_id").isNotNull())
        .groupBy("player_id", "competition_id", "match_id")
        .agg(
            *[F.sum(to_units(c(name), 6)).alias(out) for name, out in values.items()],
            F.count("xp_value").alias("_xp_n"), _type_count("Pass").alias("_passes"),
            _type_count("Shot").alias("_shots"),
            count_where((c("event_type") == "Shot") & (c("outcome") == "Goal")).alias("_goals"),
        )
    )

    def total(name: str):
        return round_any(F.coalesce(F.sum(name), F.lit(0)) / F.lit(1e6), 4)

    return per_match.groupBy("player_id", "competition_id").agg(
        total("_xt").alias("total_xt"), F.sum("_passes").alias("total_passes"), F.sum("_shots").alias("total_shots"),
        round_any(F.try_divide(F.sum("_xp") / F.lit(1e6), F.sum("_xp_n").cast("double")), 4).alias("avg_xp"),
        total("_xg").alias("total_xg"), F.sum("_goals").alias("total_goals"), F.count("*").alias("matches_played"),
    )


def with_rank_keys(totals: DataFrame) -> DataFrame:
    """Whole-number sort keys of the two ranks; a null ratio stays null and comes first."""
    per_match = ratio(F.col("total_xt"), F.col("matches_played"))
    return totals.withColumns({"_xt_key": to_units(F.col("total_xt"), 4), "_match_key": to_units(per_match, 12)})


def xt_rank(keyed: DataFrame) -> DataFrame:
    """Rank within the competition by total xT."""
    return rank_rows(keyed, ["competition_id"], "_xt_key", "xt_rank")


def xt_per_match_rank(keyed: DataFrame) -> DataFrame:
    """Rank within the competition by xT per match."""
    return rank_rows(keyed, ["competition_id"], "_match_key", "xt_per_match_rank")


def mart_competition_leaderboard(events: DataFrame, players: DataFrame, competitions: DataFrame) -> DataFrame:
    ranked = xt_per_match_rank(xt_rank(with_rank_keys(competition_totals(events))))
    named = joins.add_player_name(ranked, players)
    named = joins.join_dims_on(
        named, F.col("competition_id"), competitions, "competition_id", {"competition_name": "competition_name"}
    )
    return named.select(
        "competition_id", "competition_name", "player_id", "player_name", "total_xt", "total_passes", "total_shots",
        "avg_xp", "total_xg", "total_goals",
        round_any(F.col("total_goals") - F.col("total_xg"), 4).alias("finishing_quality"), "matches_played",
        round_any(ratio(F.col("total_xt"), F.col("matches_played")), 4).alias("xt_per_match"),
        "xt_rank", "xt_per_match_rank",
    )


def mart_pass_network(links: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    """Passer-receiver edges per match with at least two passes."""
    c = F.col
    edges = (
        links.where(c("to_player_id").isNotNull())
        .groupBy("match_id", "team_id", "from_player_id", "to_player_id")
        .agg(
            F.count("*").alias("pass_count"), count_where(c("is_successful")).alias("successful_passes"),
            round_pos(exact_avg(c("pass_distance_m"), 2), 2).alias("avg_pass_distance_m"),
            count_where(c("under_pressure")).alias("passes_under_pressure"),
        )
        .where(c("pass_count") >= MIN_EDGE_PASSES)
    )
    named = joins.add_pair_names(joins.add_team_name(edges, teams), players)
    return named.select(
        "match_id", "team_id", "team_name", "from_player_id", "from_player_name", "to_player_id", "to_player_name",
        "pass_count", "successful_passes", "avg_pass_distance_m", "passes_under_pressure",
        round_pos(ratio(c("successful_passes"), c("pass_count")), 4).alias("pass_completion_rate"),
    )


def opponent_passes(events: DataFrame) -> DataFrame:
    """Defensive actions and passes allowed per team and match.

    Passes allowed are the match's passes by any known team less the team's own, so no pass is ever joined to
    its opponents: one scan, one shuffle, then a window over the few teams of each match.
    """
    c = F.col
    is_pass = (c("event_type") == "Pass") & c("end_location_x").isNotNull()
    per_team = (
        events.where(c("team_id").isNotNull() & (is_pass | c("event_type").isin(*DEFENSIVE_TYPES)))
        .groupBy("match_id", "team_id")
        .agg(
            count_where(c("event_type").isin(*DEFENSIVE_TYPES)).alias("defensive_actions"),
            count_where(is_pass).alias("_own"),
        )
    )
    in_match = Window.partitionBy("match_id")
    allowed = F.sum("_own").over(in_match) - c("_own")
    return (
        per_team.withColumn("passes_allowed", allowed).where(c("defensive_actions") > 0)
        .select("match_id", "team_id", "defensive_actions", "passes_allowed")
    )


def mart_pressing_metrics(events: DataFrame, teams: DataFrame) -> DataFrame:
    """Passes allowed per defensive action, with its label."""
    ppda = ratio(F.col("passes_allowed"), F.col("defensive_actions"))
    return joins.add_team_name(opponent_passes(events), teams).select(
        "match_id", "team_id", "team_name", "defensive_actions", "passes_allowed",
        round_pos(ppda, 4).alias("ppda"), pressing_label(ppda).alias("pressing_intensity"),
    )


def mart_set_piece_clusters(zones: DataFrame) -> DataFrame:
    return zones.select("event_type", "cluster_label", "center_x", "center_y", "member_count")
