"""Answers of the service: built for all matches and players at once, filtered by id when asked for one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.labels import recommendation_text
from touchline.functions.numeric import round_any, round_pos, to_units
from touchline.operators import joins
from touchline.operators.running import top_per_group

# Page and list bounds of the service.
DEFAULT_LIMIT, MAX_LIMIT = 200, 2000
MAX_NEIGHBOURS = 10


def _only(df: DataFrame, column: str, value: int | None) -> DataFrame:
    return df if value is None else df.where(F.col(column) == value)


def xg_values(fact: DataFrame, match_id: int | None = None, limit: int = DEFAULT_LIMIT, offset: int = 0) -> DataFrame:
    """One page of a match's xG values in id order; without a match, that page of every match."""
    if not 0 <= limit <= MAX_LIMIT or offset < 0:
        raise ValueError("limit must be 0..2000 and offset non-negative")
    rows = fact.where(F.col("xg_value").isNotNull()).select("match_id", "event_id", "xg_value")
    if match_id is not None:
        page = rows.where(F.col("match_id") == match_id).orderBy("event_id").offset(offset).limit(limit)
        return page
    ranked = top_per_group(rows, ["match_id"], [F.col("event_id").asc()], offset + limit, "_rank")
    return ranked.where(F.col("_rank") > offset).drop("_rank")


def similar_players(
    scores: DataFrame, players: DataFrame, player_id: int | None = None, position: str | None = None, n: int = 10
) -> DataFrame:
    """Stored neighbours with name and position. The position filter applies to the chosen ten."""
    n = max(1, min(n, MAX_NEIGHBOURS))
    named = _only(scores, "player_id", player_id).join(
        players.select(F.col("player_id").alias("similar_player_id"), "player_name", "position"), "similar_player_id"
    )
    if position:
        named = named.where(F.col("position") == position)
    cols = ["player_id", "similar_player_id", "player_name", "position", "similarity_score", "rank"]
    return named.where(F.col("rank") <= n).select(*cols)


def top_threats(
    fact: DataFrame, players: DataFrame, teams: DataFrame, match_id: int | None = None, n: int = 3
) -> DataFrame:
    """Players with the largest positive xT per match, by name and team name.

    Values are summed per player id before the names are joined.
    """
    c = F.col
    sums = (
        _only(fact, "match_id", match_id).where(c("xt_value") > 0)
        .groupBy("match_id", "player_id", "team_id").agg(F.sum(to_units(c("xt_value"), 6)).alias("_u"))
    )
    named = joins.add_inner(sums, players.select("player_id", "player_name"), "player_id")
    named = joins.add_inner(named, teams.select("team_id", "team_name"), "team_id")
    total = round_pos(F.sum("_u") / F.lit(1e6), 4).alias("total_xt")
    by_name = named.groupBy("match_id", "player_name", "team_name").agg(total)
    order = [c("total_xt").desc(), c("player_name").asc(), c("team_name").asc()]
    return top_per_group(by_name, ["match_id"], order, n)


def match_summary(
    matches: DataFrame, team_summary: DataFrame, pressing: DataFrame, match_id: int | None = None
) -> DataFrame:
    """Score, xG difference and pressing label of both sides, one row per match."""
    c = F.col
    heads = _only(matches, "match_id", match_id).select(
        "match_id", "home_team", "away_team", "home_score", "away_score"
    )
    with_xg = joins.home_away(heads, team_summary, ["total_xg"])
    with_press = joins.home_away(with_xg, pressing, ["ppda", "pressing_intensity"])
    home, away = F.coalesce("home_total_xg", F.lit(0.0)), F.coalesce("away_total_xg", F.lit(0.0))
    return with_press.select(
        "match_id", "home_team", "away_team", "home_score", "away_score", home.alias("xg_home"), away.alias("xg_away"),
        round_any(home - away, 4).alias("xg_diff"), "home_ppda", "away_ppda",
        F.coalesce(c("home_pressing_intensity"), F.lit("N/A")).alias("home_pressing"),
        F.coalesce(c("away_pressing_intensity"), F.lit("N/A")).alias("away_pressing"),
    )


def match_documents(summary: DataFrame, threats: DataFrame) -> DataFrame:
    """The nested response: one JSON document per match."""
    c = F.col

    def number(value: Column) -> Column:
        return value.cast("decimal(18,4)")

    threat = F.struct(
        "rank", "player_name", c("team_name").alias("team"), number(c("total_xt")).alias("total_xt")
    )
    # At most three entries per match.
    lists = threats.groupBy("match_id").agg(F.array_sort(F.collect_list(threat)).alias("key_threats"))

    def press(side: str) -> Column:
        return F.struct(c(f"{side}_pressing").alias("label"), number(c(f"{side}_ppda")).alias("ppda")).alias(side)

    body = F.struct(
        "match_id", "home_team", "away_team", "home_score", "away_score", number(c("xg_home")).alias("xg_home"),
        number(c("xg_away")).alias("xg_away"), number(c("xg_diff")).alias("xg_diff"),
        F.struct(press("home"), press("away")).alias("pressing_intensity"),
        F.coalesce("key_threats", F.array().cast("array<struct<rank:int,player_name:string,team:string,total_xt:decimal(18,4)>>"))
        .alias("key_threats"),
    )
    joined = summary.join(lists, "match_id", "left")
    return joined.select("match_id", F.to_json(body, {"ignoreNullFields": "false"}).alias("document"))


def _profile(player_metrics: DataFrame, players: DataFrame) -> DataFrame:
    """Players with the figures of the comparison, one row per player and team (one without figures)."""
    c = F.col
    figures = player_metrics.select(
        "player_id", "team_name", "avg_xg", "pass_completion_pct", "avg_xt_per_pass", "total_shots"
    )
    zero = {"avg_xg": 0.0, "pass_completion_pct": 0.0, "avg_xt_per_pass": 0.0, "total_shots": 0}
    joined = players.select("player_id", "player_name", "position").join(figures, "player_id", "left")
    return joined.select(
        "player_id", "player_name", "position", "team_name", *[F.coalesce(c(k), F.lit(v)).alias(k) for k, v in zero.items()]
    )


def replacement_candidates(
    scores: DataFrame, players: DataFrame, player_metrics: DataFrame, player_id: int | None = None, top_n: int = 3
) -> DataFrame:
    """Best candidates per target player with their figures and differences.

    A player with figures for several teams appears once per team, and the target's figures come from one of
    their teams; team name order decides both.
    """
    c = F.col
    top_n = max(1, min(top_n, MAX_NEIGHBOURS))
    profile = _profile(player_metrics, players)
    first_team = [c("team_name").asc_nulls_last(), c("avg_xg").asc(), c("total_shots").asc()]
    target = top_per_group(_only(profile, "player_id", player_id), ["player_id"], first_team, 1, "_first")
    target = target.select(
        "player_id", c("player_name").alias("target_name"), c("avg_xg").alias("target_avg_xg"),
        c("pass_completion_pct").alias("target_pass_completion_pct"),
        c("avg_xt_per_pass").alias("target_avg_xt_per_pass"), c("total_shots").alias("target_total_shots"),
    )
    candidate = profile.withColumnRenamed("player_id", "similar_player_id")
    rows = _only(scores, "player_id", player_id).select("player_id", "similar_player_id", "similarity_score", "rank")
    joined = rows.join(candidate, "similar_player_id")
    order = [c("rank").asc(), c("similar_player_id").asc(), *first_team]
    best = top_per_group(joined, ["player_id"], order, top_n, "slot").join(target, "player_id")
    return best.withColumns(
        {
            "delta_xg": round_any(c("avg_xg") - c("target_avg_xg"), 4),
            "delta_pct": round_any(c("pass_completion_pct") - c("target_pass_completion_pct"), 2),
            "delta_xt": round_any(c("avg_xt_per_pass") - c("target_avg_xt_per_pass"), 5),
        }
    )


def recommendations(candidates: DataFrame, players: DataFrame) -> DataFrame:
    """One sentence per player: the best candidate against the player, or that there is none."""
    c = F.col
    best = candidates.where(c("slot") == 1).select(
        "player_id",
        F.struct("player_name", "similarity_score", "avg_xg", "pass_completion_pct", "delta_xg", "delta_pct").alias("best"),
        F.struct(c("target_avg_xg").alias("avg_xg"), c("target_pass_completion_pct").alias("pass_completion_pct"))
        .alias("_target"),
    )
    joined = players.select("player_id", "player_name").join(best, "player_id", "left")
    target = F.struct(
        "player_name", c("_target.avg_xg").alias("avg_xg"), c("_target.pass_completion_pct").alias("pass_completion_pct")
    )
    return joined.withColumn("target", target).select(
        "player_id", recommendation_text("target", "best").alias("recommendation")
    )


def candidate_documents(candidates: DataFrame) -> DataFrame:
    """Candidate list per target player as one JSON document (at most ten entries each)."""
    c = F.col

    def number(name: str, digits: int = 6) -> Column:
        return c(name).cast(f"decimal(18,{digits})")

    stats = F.struct(
        number("avg_xg").alias("avg_xg"), number("pass_completion_pct").alias("pass_completion_pct"),
        number("avg_xt_per_pass").alias("avg_xt_per_pass"), "total_shots",
    )
    delta = F.struct(
        number("delta_xg").alias("avg_xg"), number("delta_pct").alias("pass_completion_pct"),
        number("delta_xt").alias("avg_xt_per_pass"),
    )
    entry = F.struct(
        "slot", c("similar_player_id").alias("player_id"), "player_name", "position",
        number("similarity_score").alias("similarity_score"), stats.alias("stats"), delta.alias("delta"),
    )
    lists = candidates.groupBy("player_id").agg(F.array_sort(F.collect_list(entry)).alias("candidates"))
    body = F.to_json(F.struct("player_id", "candidates"), {"ignoreNullFields": "false"})
    return lists.select("player_id", body.alias("document"))
