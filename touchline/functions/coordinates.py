"""Pitch geometry on the common 105 x 68 m pitch."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Pitch, goal and grid sizes.
PITCH_X = 105.0
PITCH_Y = 68.0
GOAL_X = 105.0
GOAL_Y = 34.0
GOAL_WIDTH = 7.32
GRID_COLS = 16
GRID_ROWS = 12

# Native size of each provider's coordinate system.
NATIVE_SIZE = {
    "statsbomb_120x80": (120.0, 80.0),
    "opta_100x100": (100.0, 100.0),
    "wyscout_100x100": (100.0, 100.0),
}


def _scaled(value: Column, system: Column, axis: int, pitch: float) -> Column:
    out = None
    for name, size in NATIVE_SIZE.items():
        scaled = value * F.lit(pitch / size[axis])
        out = F.when(system == name, scaled) if out is None else out.when(system == name, scaled)
    return out.otherwise(value)


def normalise_x(value: Column, system: Column) -> Column:
    """Native x to metres; values of an unknown system pass through."""
    return _scaled(value, system, 0, PITCH_X)


def normalise_y(value: Column, system: Column) -> Column:
    return _scaled(value, system, 1, PITCH_Y)


def clamp(value: Column, low: float, high: float, null_safe: bool = False) -> Column:
    """Force into [low, high]. A null becomes ``low``, as null-skipping GREATEST does, unless ``null_safe``."""
    out = F.least(F.greatest(value, F.lit(low)), F.lit(high))
    return F.when(value.isNotNull(), out) if null_safe else out


def distance(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    dx, dy = x1 - x0, y1 - y0
    return F.sqrt(dx * dx + dy * dy)


def goal_distance(x: Column, y: Column) -> Column:
    return distance(x, y, F.lit(GOAL_X), F.lit(GOAL_Y))


def goal_angle(x: Column, y: Column) -> Column:
    """Angle under which the goal mouth is seen."""
    dx, dy = F.lit(GOAL_X) - x, y - F.lit(GOAL_Y)
    half = GOAL_WIDTH / 2
    return F.abs(F.atan2(F.lit(GOAL_WIDTH) * dx, dx * dx + dy * dy - F.lit(half * half)))


def grid_col(x: Column, clamped: bool = True) -> Column:
    col = F.floor(x / F.lit(PITCH_X / GRID_COLS)).cast("int")
    return F.least(col, F.lit(GRID_COLS - 1)) if clamped else col


def grid_row(y: Column, clamped: bool = True) -> Column:
    row = F.floor(y / F.lit(PITCH_Y / GRID_ROWS)).cast("int")
    return F.least(row, F.lit(GRID_ROWS - 1)) if clamped else row


def grid_cell(x: Column, y: Column) -> Column:
    """Cell number, rows first; the far edges fall into the last column and row."""
    return grid_row(y) * F.lit(GRID_COLS) + grid_col(x)


def in_corner_arc(x: Column, y: Column) -> Column:
    """Whether a point lies in one of the four corner boxes used to recognise corner deliveries."""
    # The corner boxes in metres.
    near_end = (x < 2.625) | (x > 102.375)
    near_side = (y < 2.55) | (y > 65.45)
    return near_end & near_side


def pitch_third(col: Column) -> Column:
    # Grid columns of each third.
    return (
        F.when(col.between(0, 4), "Defensive Third")
        .when(col.between(5, 10), "Middle Third")
        .when(col.between(11, 15), "Attacking Third")
    )


# Zone limits and names, the first that fits counts: name, comparison with x, x, range of y.
BOX_ZONES = (
    ("6-yard box", ">", 114, (30, 50)), ("Penalty area", ">", 102, (18, 62)), ("Attacking third", ">", 60, None),
    ("Own half / long range", None, None, None),
)
BAND_ZONES = (
    ("Six Yard Box", ">=", 102, (18, 62)), ("Penalty Area", ">=", 88, (13, 67)), ("Attacking Third", ">=", 80, None),
    ("Long Range", None, None, None),
)


def _zone(x: Column, y: Column, zones: tuple) -> Column:
    out = F.lit(zones[-1][0])
    for name, sign, limit, sides in reversed(zones[:-1]):
        fits = x > limit if sign == ">" else x >= limit
        out = F.when(fits & y.between(*sides) if sides else fits, name).otherwise(out)
    return out


def shot_zone_boxes(x: Column, y: Column) -> Column:
    """Zones of the shot-quality report, in native 120 x 80 units."""
    return _zone(x, y, BOX_ZONES)


def shot_zone_bands(x: Column, y: Column) -> Column:
    """Zones of the saved shot query; its limits differ from :func:`shot_zone_boxes`."""
    return _zone(x, y, BAND_ZONES)
