"""Sequences within a match: press triggers, xG timelines, request bursts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.labels import match_clock_sec
from touchline.functions.numeric import count_where, round_any, to_units

# Types of pressing actions, the window and the smallest count of actions.
PRESS_TYPES = ("Pressure", "Interception", "Tackle", "Block")
RECOVERY = "Ball Recovery"
PRESS_WINDOW_SEC = 5
MIN_ACTIONS = 3


def press_seconds(events: DataFrame) -> DataFrame:
    """Pressing actions and recoveries per match, team and second.

    The number of rows per match is bounded by its seconds, however many events a match has.
    """
    c = F.col
    used = c("event_type").isin(*PRESS_TYPES, RECOVERY) & c("match_id").isNotNull() & c("team_id").isNotNull()
    clock = match_clock_sec(c("minute"), c("second")).alias("sec")
    return (
        events.where(used & c("minute").isNotNull())
        .groupBy("match_id", "team_id", clock)
        .agg(
            count_where(c("event_type").isin(*PRESS_TYPES)).alias("actions"),
            count_where(c("event_type") == RECOVERY).alias("recoveries"),
        )
    )


def forward_count(seconds: DataFrame, window: int = PRESS_WINDOW_SEC) -> DataFrame:
    """Actions within ``window`` seconds from each second, both ends included."""
    ahead = Window.partitionBy("match_id", "team_id").orderBy("sec").rangeBetween(0, window)
    return seconds.withColumn("actions_ahead", F.sum("actions").over(ahead))


def qualifying_recoveries(
    events: DataFrame, window: int = PRESS_WINDOW_SEC, min_actions: int = MIN_ACTIONS
) -> DataFrame:
    """Seconds with a recovery that is followed by enough actions of the same team."""
    counted = forward_count(press_seconds(events), window)
    return counted.where((F.col("recoveries") > 0) & (F.col("actions_ahead") >= min_actions))


def trigger_actions(events: DataFrame, window: int = PRESS_WINDOW_SEC, min_actions: int = MIN_ACTIONS) -> DataFrame:
    """Pressing actions inside the window of any qualifying recovery, without a range join.

    Seconds are flagged by a second window over the per-second counts (same partitioning and order, so no new
    shuffle); the events are then matched by their own second.
    """
    c = F.col
    counted = forward_count(press_seconds(events), window)
    qualifies = F.when((c("recoveries") > 0) & (c("actions_ahead") >= min_actions), F.lit(1))
    behind = Window.partitionBy("match_id", "team_id").orderBy("sec").rangeBetween(-window, 0)
    flagged = (
        counted.withColumn("_q", qualifies).withColumn("_flag", F.max("_q").over(behind))
        .where((c("_flag") == 1) & (c("actions") > 0)).select("match_id", "team_id", "sec")
    )
    actions = events.where(c("event_type").isin(*PRESS_TYPES)).select(
        "event_id", "match_id", "team_id", match_clock_sec(c("minute"), c("second")).alias("sec")
    )
    return actions.join(flagged, ["match_id", "team_id", "sec"], "left_semi")


def actions_after(
    recoveries: DataFrame, actions: DataFrame, sec: int = PRESS_WINDOW_SEC, keys: Sequence[str] = ("match_id", "team_id")
) -> DataFrame:
    """``*keys, recovery_id, action_id, recovery_sec, action_sec``: every action up to ``sec`` seconds after a recovery, both
    ends included, that shares its keys.

    Both sides have the keys, ``event_id`` and ``sec``. Time is cut into slots as long as the window, so an action lies in the
    slot of its recovery or in the next one: a recovery goes to two slots, an action to its own, and the join is an
    equality of keys and slot. No match is one task, and a busy slot can be split like any skewed key. Rows with a null
    key or second pair with nothing; repeated rows pair each.
    """
    width, c = max(int(sec), 1), F.col
    slot = F.floor(c("sec") / F.lit(width))
    begun = recoveries.select(
        *keys, c("event_id").alias("recovery_id"), c("sec").alias("recovery_sec"), F.explode(F.array(slot, slot + 1)).alias("_slot")
    )
    done = actions.select(*keys, c("event_id").alias("action_id"), c("sec").alias("action_sec"), slot.alias("_slot"))
    near = c("action_sec").between(c("recovery_sec"), c("recovery_sec") + F.lit(int(sec)))
    return begun.join(done, [*keys, "_slot"]).where(near).select(*keys, "recovery_id", "action_id", "recovery_sec", "action_sec")


def distinct_ids(df: DataFrame, key: str = "event_id") -> DataFrame:
    return df.select(key).distinct()


def press_triggers(events: DataFrame, window: int = PRESS_WINDOW_SEC, min_actions: int = MIN_ACTIONS) -> DataFrame:
    """Ids of the actions that make up press triggers, each once."""
    return distinct_ids(trigger_actions(events, window, min_actions))


def xg_timeline(shots: DataFrame) -> DataFrame:
    """Cumulative xG of each side after every shot. A shot without xG adds nothing.

    ``shots`` needs match_id, team_id, minute, second, event_id, is_goal and xg_value.
    """
    c = F.col
    rows = shots.select(
        "match_id", "team_id", "event_id", "minute", F.coalesce("second", F.lit(0)).alias("second"), "is_goal",
        F.coalesce("xg_value", F.lit(0.0)).alias("xg"),
    )
    order = [c("minute").asc(), c("second").asc(), c("event_id").asc()]
    # A side has a few dozen shots in a match, so no partition of this window is large.
    so_far = Window.partitionBy("match_id", "team_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    units = F.sum(to_units(c("xg"), 6)).over(so_far)
    return rows.withColumn("cumulative_xg", round_any(units / F.lit(1e6), 6))


def xg_verdict(sides: DataFrame) -> DataFrame:
    """Whether the score agrees with the xG. Needs home/away score and home_xg/away_xg per match."""
    c = F.col
    consistent = (c("home_xg") > c("away_xg")) == (c("home_score") > c("away_score"))
    close = (c("home_score") == c("away_score")) & (F.abs(c("home_xg") - c("away_xg")) < 0.3)
    winner = (
        F.when(c("home_xg") > c("away_xg"), "home").when(c("away_xg") > c("home_xg"), "away").otherwise("draw")
    )
    verdict = F.when(consistent, "CONSISTENT").when(close, "FAIR DRAW").otherwise("DISCREPANCY")
    return sides.withColumns({"xg_winner": winner, "verdict": verdict})


def requests_per_key(df: DataFrame, key: str, ts: str, limit: int = 60, window: int = 60) -> DataFrame:
    """Attempts per key in the ``window`` seconds up to each second, and whether they pass ``limit``.

    Attempts are counted per second first. Time is cut into blocks of a hundred windows; the last seconds of a
    block are also given to the next one, so even a key that never rests is counted by many tasks.
    """
    c = F.col
    block = 100 * window
    seconds = df.groupBy(c(key), F.unix_timestamp(c(ts).cast("timestamp")).alias("sec")).agg(
        F.count("*").alias("attempts")
    )
    own = F.floor(c("sec") / F.lit(block))
    spill = F.when(c("sec") >= (own + 1) * F.lit(block) - F.lit(window), F.array(own, own + 1)).otherwise(F.array(own))
    spread = seconds.withColumn("_own", own).withColumn("_block", F.explode(spill))
    recent = Window.partitionBy(key, "_block").orderBy("sec").rangeBetween(-window, 0)
    counted = spread.withColumn("attempts_in_window", F.sum("attempts").over(recent))
    return counted.where(c("_block") == c("_own")).select(
        key, "sec", "attempts", "attempts_in_window", (c("attempts_in_window") > limit).alias("over_limit")
    )
