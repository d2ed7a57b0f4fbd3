"""Data checks. Each returns the failing rows; a gate raises when any check has some."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from touchline.functions.coordinates import PITCH_X, PITCH_Y
from touchline.functions.numeric import count_where
from touchline.session import materialise

FEW_DIGESTS = 500_000  # digests of eight bytes that a task holds at once


class GateError(RuntimeError):
    """A layer did not pass its checks."""


def outside(column: str, low: float | None = None, high: float | None = None, inclusive: bool = True) -> Column:
    """True for a value beyond the bounds; nulls pass."""
    value, failed = F.col(column), F.lit(False)
    if low is not None:
        failed = failed | ((value < low) if inclusive else (value <= low))
    if high is not None:
        failed = failed | ((value > high) if inclusive else (value >= high))
    return failed


def not_accepted(column: str, values: Sequence) -> Column:
    """True for a value outside the list; nulls pass."""
    return ~F.col(column).isin(*values)


def off_pitch() -> Column:
    return outside("location_x", 0, PITCH_X) | outside("location_y", 0, PITCH_Y)


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def check_unique(df: DataFrame, column: str, wide: bool = False) -> DataFrame:
    """Values that occur more than once, with their count.

    A ``wide`` column (a payload) is counted by a digest of eight bytes first, and only rows whose digest was seen twice
    go on to be compared by value: a digest that two values share costs time, not a wrong answer. The digests seen twice
    are written; up to ``FEW_DIGESTS`` of them are broadcast and no other payload is moved. Beyond that all values are
    counted: copies are added up in each task first, and a payload is not moved, or sorted, once for every row that has it.
    """
    present = df.where(F.col(column).isNotNull())
    if wide:
        digest = F.xxhash64(column).alias("_digest")
        twice = present.select(digest).groupBy("_digest").count().where("count > 1").select("_digest")
        twice = materialise(twice, "seen-twice")
        if twice.count() <= FEW_DIGESTS:
            present = present.select(column, digest).join(F.broadcast(twice), "_digest", "left_semi")
    seen = present.groupBy(column).agg(F.count("*").alias("n_records"))
    return seen.where(F.col("n_records") > 1)


def check_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(not_accepted(column, values))


def check_range(
    df: DataFrame, column: str, low: float | None = None, high: float | None = None, inclusive: bool = True
) -> DataFrame:
    return df.where(outside(column, low, high, inclusive))


def assert_coords_in_range(silver: DataFrame) -> DataFrame:
    return silver.where(off_pitch()).select("event_id", "location_x", "location_y", "coord_system")


def tally(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Failing rows of many row-level checks on one table, counted in one scan: ``check``, ``failing``."""
    counts = df.agg(*[count_where(condition).alias(name) for name, condition in conditions.items()])
    entries = F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("failing")) for n in conditions])
    return counts.select(F.explode(entries).alias("e")).select("e.check", "e.failing")


def duplicates(df: DataFrame, column: str, name: str) -> DataFrame:
    return check_unique(df, column).agg(F.count("*").alias("failing")).select(F.lit(name).alias("check"), "failing")


class Watch:
    """Counts the failing rows of a table's checks while the table is written, without a scan of its own.

    Put :meth:`on` right below the write, behind the last shuffle: Spark counts a task of the writing stage once however
    often it is retried, while a stage in front of a shuffle may run, and count, again.
    """

    def __init__(self, conditions: Mapping[str, Column]):
        self.conditions = dict(conditions)
        self.seen = Observation()

    def on(self, df: DataFrame) -> DataFrame:
        counts = [count_where(condition).alias(name) for name, condition in self.conditions.items()]
        return df.observe(self.seen, F.count(F.lit(1)).alias(_ROWS), *counts)

    def failing(self) -> dict[str, int]:
        """Failing rows per check, once the write is done."""
        counts = dict(self.seen.get)
        if _ROWS not in counts:
            raise GateError("the write reported no counts")
        return {name: int(counts[name]) for name in self.conditions}

    def tallies(self, spark: SparkSession) -> DataFrame:
        """``check, failing`` as :func:`tally` gives them."""
        return spark.createDataFrame(list(self.failing().items()), "check string, failing bigint")


_ROWS = "rows of the table"


def _union(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def gate(layer: str, failures: DataFrame) -> None:
    """Raise if any check of a layer has failing rows, so that later steps do not run."""
    refuse(layer, {row["check"]: row["failing"] for row in failures.where(F.col("failing") > 0).collect()})  # one row per check


def refuse(layer: str, failing: Mapping[str, int]) -> None:
    failed = ", ".join(f"{check}: {n}" for check, n in failing.items() if n)
    if failed:
        raise GateError(f"{layer} checks failed ({failed})")


# Allowed codes per layer.
PROVIDERS = ("statsbomb", "opta", "wyscout")
SYSTEMS = ("statsbomb_120x80", "opta_100x100", "wyscout_100x100")


def _missing(*columns: str) -> dict[str, Column]:
    return {f"{name}_not_null": F.col(name).isNull() for name in columns}


def bronze_rows() -> dict[str, Column]:
    """The checks of bronze that look at one row."""
    return {
        **_missing("event_id", "match_id", "event_type", "provider", "coord_system"),
        "provider_accepted": not_accepted("provider", PROVIDERS),
        "coord_system_accepted": not_accepted("coord_system", SYSTEMS),
    }


def bronze_failures(bronze: DataFrame) -> DataFrame:
    return _union(tally(bronze, bronze_rows()), duplicates(bronze, "event_id", "event_id_unique"))


def silver_failures(
    events: DataFrame, passes: DataFrame, shots: DataFrame, links: DataFrame, strict: bool = False
) -> DataFrame:
    """Checks on the silver views. The provider list lacks the third feed unless ``strict``."""
    allowed = PROVIDERS if strict else PROVIDERS[:2]
    event_rows = {
        **_missing("event_id", "match_id", "event_type", "location_x", "location_y"),
        "provider_accepted": not_accepted("provider", allowed),
        "location_x_range": outside("location_x", 0, 105), "location_y_range": outside("location_y", 0, 68),
        "coords_in_range": off_pitch(),
    }
    shot_rows = {
        "shot_distance_range": outside("distance_to_goal", 0, 130), "shot_angle_range": outside("shot_angle", 0, 3.1416),
        "is_goal_accepted": not_accepted("is_goal", (0, 1)),
    }
    return _union(
        tally(events, event_rows), duplicates(events, "event_id", "event_id_unique"), tally(shots, shot_rows),
        tally(passes, {"pass_distance_range": outside("pass_distance_m", 0, 150)}),
        tally(links, {"link_passer_not_null": F.col("from_player_id").isNull()}),
    )


def gold_failures(player_metrics: DataFrame, team_summary: DataFrame, shot_map: DataFrame) -> DataFrame:
    shot_rows = {
        "shot_id_not_null": F.col("event_id").isNull(), "x_range": outside("x_105", 0, 105),
        "y_range": outside("y_68", 0, 68),
    }
    return _union(
        tally(player_metrics, {f"player_metrics_{k}": v for k, v in _missing("player_id", "match_id").items()}),
        tally(team_summary, {f"team_summary_{k}": v for k, v in _missing("team_id", "match_id").items()}),
        tally(shot_map, shot_rows), duplicates(shot_map, "event_id", "shot_id_unique"),
    )


def mart_failures(
    players: DataFrame, teams: DataFrame, matches: DataFrame, pressing: DataFrame, network: DataFrame
) -> DataFrame:
    edge_rows = {**_missing("from_player_id", "to_player_id"), "pass_count_range": outside("pass_count", 2)}
    return _union(
        tally(players, _missing("player_id")), tally(teams, _missing("team_id")), duplicates(teams, "team_id", "team_id_unique"),
        tally(matches, _missing("match_id")), duplicates(matches, "match_id", "match_id_unique"),
        tally(pressing, {"ppda_range": outside("ppda", 0, 100)}), tally(network, edge_rows),
    )
