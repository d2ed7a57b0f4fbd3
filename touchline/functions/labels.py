"""Clock, clip and wording helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CLIP_LEAD_MS = 3000
CLIP_LAG_MS = 5000


def match_clock_sec(minute: Column, second: Column) -> Column:
    return minute * F.lit(60) + F.coalesce(second, F.lit(0))


def game_clock_ms(minute: Column, second: Column) -> Column:
    return (match_clock_sec(minute, second) * F.lit(1000)).cast("int")


def clip_window(clock_ms: Column, lead: int = CLIP_LEAD_MS, lag: int = CLIP_LAG_MS) -> tuple[Column, Column]:
    """Start and end of a clip around an action; the start never falls before kick-off."""
    return F.greatest(clock_ms - F.lit(lead), F.lit(0)), clock_ms + F.lit(lag)


def clip_code(rank: Column) -> Column:
    return F.format_string("xT_ACTION_%02d", rank)


def fixed(value: Column, digits: int) -> Column:
    """A number as text with a fixed count of decimals, rounded on its binary value as printf does.

    A cast to decimal would round the shortest decimal form instead: 0.0045 is stored a little below that and
    prints as 0.004. The product with the power of ten is rounded too, so a half is settled by what that
    rounding left out (the product of the halves of the value's digits is exact); a true half goes to the even
    number.
    """
    power = F.lit(float(10**digits))
    size = F.abs(value.cast("double"))
    product = size * power
    spread = size * F.lit(float(2**27 + 1))
    high = spread - (spread - size)
    left_out = (high * power - product) + (size - high) * power
    below = F.floor(product)
    part = product - below
    half_up = F.when(left_out != 0, left_out > 0).otherwise(below % 2 == 1)
    up = F.when(part == 0.5, half_up).otherwise(part > 0.5)
    units = below + up.cast("bigint")
    text = (units / power).cast(f"decimal(18,{digits})").cast("string")
    return F.when(value < 0, F.concat(F.lit("-"), text)).otherwise(text)


# The wording of the clip line, of the labels and of the sentences below.
def clip_label() -> Column:
    """One line per clip; parts without a value are left out. Reads the clip columns by name."""
    c = F.col
    start = F.concat(F.lit("From: ("), fixed(c("location_x"), 1), F.lit(", "), fixed(c("location_y"), 1), F.lit(")"))
    end = F.concat(F.lit("To: ("), fixed(c("end_location_x"), 1), F.lit(", "), fixed(c("end_location_y"), 1), F.lit(")"))
    return F.concat_ws(
        " | ",
        F.concat(F.lit("xT: "), fixed(c("xt_value"), 4)),
        F.concat(F.lit("xG: "), fixed(c("xg_value"), 4)),
        F.concat(F.lit("Type: "), c("event_type")),
        F.concat(F.lit("Player: "), F.coalesce(c("player_name"), F.lit("Unknown"))),
        F.concat(F.lit("Team: "), F.coalesce(c("team_name"), F.lit("Unknown"))),
        start,
        F.when(c("end_location_x").isNotNull(), end),
        F.when(c("under_pressure"), F.lit("Under Pressure: Yes")),
    )


def pressing_label(ppda: Column) -> Column:
    return F.when(ppda < 10, "High").when(ppda < 15, "Medium").otherwise("Low")


def display_label(player: Column, team: Column) -> Column:
    return F.concat(player, F.lit("  ("), team, F.lit(")"))


def surname(name: Column) -> Column:
    return F.element_at(F.split(F.trim(name), "\\s+"), -1)


def direction(delta: Column) -> Column:
    return F.when(delta >= 0, "higher").otherwise("lower")


def recommendation_text(target: str, best: str) -> Column:
    """Sentence comparing a player with the best candidate.

    ``target`` and ``best`` are struct columns with player_name, avg_xg and pass_completion_pct; ``best``
    also holds similarity_score, delta_xg and delta_pct. A null ``best`` gives the no-candidate sentence.
    """
    t, b = F.col(target), F.col(best)
    found = F.concat(
        F.lit("Replacing "), t["player_name"], F.lit(": best match is "), b["player_name"],
        F.lit(" (similarity "), fixed(b["similarity_score"], 2),
        F.lit("). xG/shot "), fixed(b["avg_xg"], 3), F.lit(" vs "), fixed(t["avg_xg"], 3),
        F.lit(" ("), direction(b["delta_xg"]),
        F.lit("), pass completion "), fixed(b["pass_completion_pct"], 1), F.lit("% vs "),
        fixed(t["pass_completion_pct"], 1), F.lit("% ("), direction(b["delta_pct"]), F.lit(")."),
    )
    none = F.concat(F.lit("No replacement candidates found for "), t["player_name"], F.lit("."))
    return F.when(b.isNotNull(), found).otherwise(none)
