"""Clip lists and the data behind the match report and the match notebook."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.labels import clip_code, clip_label, clip_window, game_clock_ms, surname
from touchline.functions.numeric import count_where, exact_avg, exact_sum, ratio, round_any, round_pos
from touchline.operators import joins, xt
from touchline.operators.running import top_per_group, top_rows



def _xt_order():
    return [F.col("xt_value").desc(), F.col("event_id").asc()]


def clip_candidates(events: DataFrame) -> DataFrame:
    """Passes and carries with a value. ``events`` is :func:`silver.enriched_events`."""
    return events.where(F.col("xt_value").isNotNull() & F.col("event_type").isin(*xt.MOVE_TYPES))


def top_xt_actions(events: DataFrame, players: DataFrame, teams: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` most valuable passes and carries of the whole table; names are joined to those rows only."""
    return joins.add_names(top_rows(clip_candidates(events), _xt_order(), n), players, teams)


def clips(
    events: DataFrame, players: DataFrame, teams: DataFrame, match_id: int | None = None, n: int = 25
) -> DataFrame:
    """Clip list of a match, or of every match: rank, clip window, code and label of its best ``n`` actions."""
    c = F.col
    rows = clip_candidates(events)
    if match_id is not None:
        rows = rows.where(c("match_id") == match_id)
    best = joins.add_names(top_per_group(rows, ["match_id"], _xt_order(), n), players, teams)
    clock = game_clock_ms(c("minute"), c("second"))
    start, end = clip_window(clock)
    return best.select(
        "match_id", "rank", "event_id", start.alias("start_ms"), end.alias("end_ms"),
        clip_code(c("rank")).alias("code"), clip_label().alias("label"), "event_type", "minute",
        F.coalesce("second", F.lit(0)).alias("second"), "location_x", "location_y", "end_location_x",
        "end_location_y", "xt_value", "xg_value", "player_name", "team_name", "under_pressure",
    )


def top_actions_bi(fact: DataFrame, players: DataFrame, teams: DataFrame, n: int = 25) -> DataFrame:
    """Highest single xT events of the fact table, shots included, in native units."""
    c = F.col
    kept = fact.where(c("xt_value").isNotNull() & c("event_type").isin(*xt.MOVE_TYPES, "Shot"))
    named = joins.add_names(kept.orderBy(*_xt_order()).limit(n), players, teams)
    return named.select(
        "event_id", "minute", "second", "event_type", "player_name", "team_name",
        round_any(c("location_x"), 1).alias("loc_x"), round_any(c("location_y"), 1).alias("loc_y"),
        round_any(c("end_location_x"), 1).alias("end_x"), round_any(c("end_location_y"), 1).alias("end_y"),
        round_any(c("xt_value"), 4).alias("xt_value"), round_any(c("xp_value"), 4).alias("xp_value"),
        "under_pressure",
    )


def match_events(fact: DataFrame, players: DataFrame, teams: DataFrame, match_id: int | None = None) -> DataFrame:
    """Event extract with names."""
    rows = fact if match_id is None else fact.where(F.col("match_id") == match_id)
    return joins.add_names(rows, players, teams).select(
        "match_id", "event_id", "event_type", "minute", "second", "location_x", "location_y", "end_location_x",
        "end_location_y", "xt_value", "xp_value", "under_pressure", "player_name", "team_name", "team_id",
    )


def match_header(matches: DataFrame, match_id: int | None = None) -> DataFrame:
    rows = matches if match_id is None else matches.where(F.col("match_id") == match_id)
    return rows.select("match_id", "home_team", "away_team", "home_score", "away_score", "match_date")


def pass_network_nodes(fact: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    """Mean start point and pass count per match, team name and player name, in native units.

    Native coordinates are summed in ten-thousandths per id before names are joined.
    """
    c = F.col
    rows = fact.where((c("event_type") == "Pass") & c("location_x").isNotNull() & c("end_location_x").isNotNull())
    sums = rows.groupBy("match_id", "team_id", "player_id").agg(
        exact_sum(c("location_x"), 4).alias("_x"), exact_sum(c("location_y"), 4).alias("_y"), F.count("*").alias("_n")
    )
    named = joins.add_names(sums, players, teams).where(c("player_name").isNotNull() & c("team_name").isNotNull())
    count = F.sum("_n")
    return named.groupBy("match_id", "team_name", "player_name").agg(
        round_pos(ratio(exact_sum(c("_x"), 4), count), 4).alias("avg_x"),
        round_pos(ratio(exact_sum(c("_y"), 4), count), 4).alias("avg_y"), count.alias("count"),
    ).withColumn("surname", surname(c("player_name")))


def top_events_per_match(fact: DataFrame, k: int = 15) -> DataFrame:
    best = top_per_group(fact.where(F.col("xt_value").isNotNull()), ["match_id"], _xt_order(), k)
    return best.select("match_id", "rank", "event_id", "event_type", "xt_value", "location_x", "location_y")


def player_xt_per_match(fact: DataFrame, players: DataFrame, teams: DataFrame, k: int = 10) -> DataFrame:
    """Players with the largest xT total of each match."""
    c = F.col
    sums = fact.where(c("xt_value").isNotNull()).groupBy("match_id", "player_id", "team_id").agg(
        exact_sum(c("xt_value"), 6).alias("_xt")
    )
    named = joins.add_names(sums, players, teams).where(c("player_name").isNotNull() & c("team_name").isNotNull())
    by_name = named.groupBy("match_id", "player_name", "team_name").agg(
        round_any(exact_sum(c("_xt"), 6), 6).alias("xt_value")
    )
    order = [c("xt_value").desc(), c("player_name").asc(), c("team_name").asc()]
    return top_per_group(by_name, ["match_id"], order, k)


def positive_xt(events: DataFrame, surface: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    """xT gained per player and match, counting only moves that gained; every move with an end point counts.

    ``events`` has coordinates on the common pitch with missing end points left null.
    """
    c = F.col
    moves = events.where(c("event_type").isin(*xt.MOVE_TYPES) & c("end_location_x").isNotNull())
    cells = moves.select(
        "match_id", "player_id", "team_id", xt.xy.grid_cell(c("location_x"), c("location_y")).alias("cell"),
        xt.xy.grid_cell(c("end_location_x"), c("end_location_y")).alias("end_cell"),
    )
    # Many moves share a pair of cells; count the pairs, then value each once.
    pairs = cells.groupBy("match_id", "player_id", "team_id", "cell", "end_cell").agg(F.count("*").alias("_n"))
    delta = round_any(c("end_xt") - c("start_xt"), 6)
    gains = xt.lookup_cells(pairs, surface).withColumn("_delta", delta).where(c("_delta") > 0)
    sums = gains.groupBy("match_id", "player_id", "team_id").agg(
        (F.sum(F.floor(c("_delta") * 1e6 + 0.5) * c("_n")) / F.lit(1e6)).alias("_xt")
    )
    named = joins.add_names(sums, players, teams)
    return named.select(
        "match_id", "player_id", "team_id", F.coalesce("player_name", F.lit("Unknown")).alias("player"),
        F.coalesce("team_name", F.lit("Unknown")).alias("team"), round_pos(c("_xt"), 6).alias("xt_delta"),
    )


def match_player_profile(events: DataFrame, gains: DataFrame) -> DataFrame:
    """Mean xG per shot, completion percentage and xT per pass of every player in every match.

    ``events`` is :func:`silver.enriched_events`; ``gains`` is :func:`positive_xt`.
    """
    c = F.col
    is_pass, is_shot = c("event_type") == "Pass", c("event_type") == "Shot"
    xg = F.when(is_shot, F.coalesce("xg_value", F.lit(0.0)))
    rows = events.where(c("player_id").isNotNull() & (is_pass | is_shot)).groupBy("match_id", "player_id").agg(
        count_where(is_pass).alias("passes"), count_where(is_shot).alias("shots"),
        F.coalesce(round_any(exact_avg(xg, 6), 6), F.lit(0.0)).alias("avg_xg"),
        F.coalesce(round_pos(ratio(count_where(is_pass & (c("outcome") == "Unknown")) * 100.0, count_where(is_pass)), 4),
                   F.lit(0.0)).alias("pass_completion"),
    )
    total = gains.groupBy("match_id", "player_id").agg(exact_sum(c("xt_delta"), 6).alias("_xt"))
    joined = rows.join(total, ["match_id", "player_id"], "left").withColumn("_xt", F.coalesce("_xt", F.lit(0.0)))
    per_pass = c("_xt") / F.greatest(c("passes"), F.lit(1)).cast("double")
    return joined.select(
        "match_id", "player_id", "passes", "shots", "avg_xg", "pass_completion", round_pos(c("_xt"), 6).alias("total_xt"),
        round_pos(per_pass, 6).alias("xt_per_pass"),
    )


def verify_top_cells(surface: DataFrame, n: int = 5) -> DataFrame:
    best = surface.orderBy(F.desc("xt_value"), "grid_row", "grid_col").limit(n)
    return best.select("grid_col", "grid_row", round_any(F.col("xt_value"), 4).alias("xt"))


def verify_top_actions(fact: DataFrame, players: DataFrame, n: int = 10) -> DataFrame:
    c = F.col
    best = fact.where(c("xt_value").isNotNull()).orderBy(*_xt_order()).limit(n)
    return joins.add_player_name(best, players).select(
        "event_id", "event_type", "player_name", round_any(c("xt_value"), 4).alias("xt"),
        round_any(c("xp_value"), 4).alias("xp"),
    )


def verify_ledger(ledger: DataFrame) -> DataFrame:
    """What was loaded: matches and events per status and competition."""
    return ledger.groupBy("status", "competition_id").agg(
        F.count("*").alias("matches"), F.sum("event_count").cast("bigint").alias("events")
    )


def verify_bundle(surface: DataFrame, fact: DataFrame, players: DataFrame, ledger: DataFrame) -> DataFrame:
    """The verification listing in one table: best cells, best actions, and the ledger by status and competition."""
    c = F.col

    def section(name: str, df: DataFrame, order: list, item, value) -> DataFrame:
        place = F.row_number().over(Window.orderBy(*order))  # a handful of rows, or one per status and competition
        return df.select(F.lit(name).alias("section"), place.alias("place"), item.alias("item"), value.alias("value"))

    # Places follow the stored value: cells that look alike with four digits keep their order.
    cell_order = [F.desc("xt_value"), c("grid_row"), c("grid_col")]
    cells = surface.orderBy(*cell_order).limit(5)
    best = fact.where(c("xt_value").isNotNull()).orderBy(*_xt_order()).limit(10)
    loaded = verify_ledger(ledger)
    return (
        section("cell", cells, cell_order, F.concat_ws(",", "grid_col", "grid_row"), round_any(c("xt_value"), 4))
        .unionByName(section("action", best, _xt_order(), c("event_id"), round_any(c("xt_value"), 4)))
        .unionByName(section("ledger", loaded, [c("status"), c("competition_id")], F.concat_ws(",", "status", "competition_id"),
                             c("matches").cast("double")))
    )
