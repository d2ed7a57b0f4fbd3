"""Join shapes shared by the marts and reports.

No broadcast hints here: a dimension may have outgrown a broadcast. Catalyst and AQE broadcast a side when its
measured size is below the threshold, and AQE splits a skewed key otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def full_outer_merge(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join with the keys merged; columns must not clash. Null keys stay apart on either side."""
    return left.join(right, list(keys), "full")


def join_dims_on(df: DataFrame, key: Column, dim: DataFrame, dim_key: str, take: dict[str, str]) -> DataFrame:
    """Left join a dimension on an expression and take some of its columns under new names."""
    side = dim.select(F.col(dim_key).alias("_dim_key"), *[F.col(src).alias(dst) for dst, src in take.items()])
    return df.join(side, key == F.col("_dim_key"), "left").drop("_dim_key")


def add_player_name(df: DataFrame, players: DataFrame, key: str = "player_id", out: str = "player_name") -> DataFrame:
    return join_dims_on(df, F.col(key), players, "player_id", {out: "player_name"})


def add_team_name(df: DataFrame, teams: DataFrame, key: str = "team_id", out: str = "team_name") -> DataFrame:
    return join_dims_on(df, F.col(key), teams, "team_id", {out: "team_name"})


def add_names(df: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    return add_team_name(add_player_name(df, players), teams)


def add_pair_names(edges: DataFrame, players: DataFrame) -> DataFrame:
    """Names of both ends of an edge: the player dimension joined twice."""
    named = add_player_name(edges, players, "from_player_id", "from_player_name")
    return add_player_name(named, players, "to_player_id", "to_player_name")


def matches_with_aggregates(matches: DataFrame, agg: DataFrame) -> DataFrame:
    """Every match, with its aggregates where it has events."""
    return matches.join(agg, "match_id", "left")


def with_competition(matches: DataFrame, competitions: DataFrame) -> DataFrame:
    return matches.join(competitions, "competition_id", "inner")


def home_away(matches: DataFrame, per_team: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Attach per-team match columns twice, by the home and the away team's name."""
    out = matches
    for side in ("home", "away"):
        part = per_team.select(
            F.col("match_id").alias("_match"), F.col("team_name").alias("_team"),
            *[F.col(c).alias(f"{side}_{c}") for c in cols],
        )
        on = (F.col("match_id") == F.col("_match")) & (F.col(f"{side}_team") == F.col("_team"))
        out = out.join(part, on, "left").drop("_match", "_team")
    return out


def home_away_split(events: DataFrame, matches: DataFrame, teams: DataFrame, value: str, digits: int) -> DataFrame:
    """Sum of ``value`` per match and side, as exact home and away totals.

    Events are summed per (match, team) before either dimension is joined, so the joins see two or three rows
    per match instead of every event.
    """
    from touchline.functions.numeric import to_units

    per_team = events.groupBy("match_id", "team_id").agg(F.sum(to_units(F.col(value), digits)).alias("_units"))
    named = add_inner(per_team, matches.select("match_id", "home_team", "away_team"), "match_id")
    named = add_inner(named, teams.select("team_id", "team_name"), "team_id")

    def side(column: str) -> Column:
        mine = F.when(F.col("team_name") == F.col(column), F.col("_units")).otherwise(F.lit(0))
        return F.sum(mine) / F.lit(float(10**digits))

    return named.groupBy("match_id").agg(side("home_team").alias("home"), side("away_team").alias("away"))


def add_inner(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    return df.join(dim, key, "inner")
