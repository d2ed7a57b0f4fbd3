"""Expected threat: counts per grid cell, value iteration, value per event.

The events shrink to at most 192 cells and 36,864 cell-to-cell edges in one aggregation. The iteration then
runs on a single row of arrays whose size is fixed by the grid, inside one expression, instead of ten joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions import coordinates as xy
from touchline.functions.numeric import count_where, ratio, round_any

ITERATIONS = 10
CELLS = xy.GRID_COLS * xy.GRID_ROWS
# Moves, and the outcomes of a completed one besides null.
MOVE_TYPES = ("Pass", "Carry")
COMPLETED = ("Unknown", "")


def completed_move(strict: bool = False) -> Column:
    """Pass or carry that reached its end point. ``strict`` also accepts the third feed's success word."""
    words = (*COMPLETED, "Success") if strict else COMPLETED
    c = F.col
    ended = c("end_location_x").isNotNull() & c("end_location_y").isNotNull()
    return c("event_type").isin(*MOVE_TYPES) & (c("outcome").isNull() | c("outcome").isin(*words)) & ended


def xt_actions(events: DataFrame, strict: bool = False) -> DataFrame:
    """Passes, carries and shots with their start cell and, for completed moves, their end cell."""
    c = F.col
    used = c("location_x").isNotNull() & c("location_y").isNotNull() & c("event_type").isin(*MOVE_TYPES, "Shot")
    end = F.when(completed_move(strict), xy.grid_cell(c("end_location_x"), c("end_location_y")))
    return events.where(used).select(
        *[name for name in ("event_id", "competition_id", "match_id", "player_id", "team_id") if name in events.columns],
        "event_type", "outcome", xy.grid_cell(c("location_x"), c("location_y")).alias("cell"), end.alias("end_cell"),
    )


def cell_edges(actions: DataFrame) -> DataFrame:
    """The only pass over the events: counts per (cell, end cell); the end cell is null for other actions.

    Every task reduces its rows to at most 192 x 193 groups before the shuffle.
    """
    shot = F.col("event_type") == "Shot"
    return actions.groupBy("cell", "end_cell").agg(
        F.count("*").alias("actions"), count_where(shot).alias("shots"),
        count_where(shot & (F.col("outcome") == "Goal")).alias("goals"),
    )


def cell_counts(edges: DataFrame) -> DataFrame:
    """Actions, shots, goals and completed moves per start cell."""
    moves = F.coalesce(F.sum(F.when(F.col("end_cell").isNotNull(), F.col("actions"))), F.lit(0))
    return edges.groupBy("cell").agg(
        F.sum("actions").alias("actions"), F.sum("shots").alias("shots"), F.sum("goals").alias("goals"),
        moves.alias("moves"),
    )


def cell_probabilities(edges: DataFrame) -> DataFrame:
    """Shot and goal probability per cell with any action."""
    counts = cell_counts(edges)
    return counts.select(
        "cell", F.coalesce(ratio(F.col("shots"), F.col("actions")), F.lit(0.0)).alias("shot_prob"),
        F.coalesce(ratio(F.col("goals"), F.col("shots")), F.lit(0.0)).alias("goal_prob"),
    )


def transitions(edges: DataFrame) -> DataFrame:
    """Share of a cell's completed moves that end in each cell (sparse)."""
    moves = edges.where(F.col("end_cell").isNotNull())
    totals = moves.groupBy("cell").agg(F.sum("actions").alias("_total"))
    return moves.join(totals, "cell").select(
        F.col("cell").alias("src"), F.col("end_cell").alias("dst"), ratio(F.col("actions"), F.col("_total")).alias("p")
    )


def _cell_rows(edges: DataFrame) -> DataFrame:
    """One row per start cell: probabilities and the list of its moves, ordered by end cell."""
    moves = F.array_sort(
        F.collect_list(F.when(F.col("end_cell").isNotNull(), F.struct(F.col("end_cell").alias("dst"), F.col("actions").alias("n"))))
    )
    return edges.groupBy("cell").agg(
        ratio(F.sum("shots"), F.sum("actions")).alias("shot_prob"),
        F.coalesce(ratio(F.sum("goals"), F.sum("shots")), F.lit(0.0)).alias("goal_prob"),
        moves.alias("moves"),
        F.coalesce(F.sum(F.when(F.col("end_cell").isNotNull(), F.col("actions"))), F.lit(0)).alias("n_moves"),
    )


def solve_cells(cells: DataFrame, iterations: int = ITERATIONS) -> DataFrame:
    """Value iteration. ``cells``: cell, shot_prob, goal_prob, moves (array of dst, n) and n_moves.

    xT = S*G + (1 - S) * sum over moves of share * xT(end cell), started from zero.
    """
    row = cells.select(
        "cell", (F.col("shot_prob") * F.col("goal_prob")).alias("own"), (1 - F.col("shot_prob")).alias("stay"),
        "moves", F.col("n_moves").cast("double").alias("total"),
    )
    # At most 192 entries, a size set by the grid.
    one = row.agg(F.collect_list(F.struct("*")).alias("cells"))
    by_cell = F.map_from_entries(F.transform("cells", lambda r: F.struct(r["cell"], r)))
    numbers = F.sequence(F.lit(0), F.lit(CELLS - 1))
    one = one.select(F.transform(numbers, lambda i: F.try_element_at(by_cell, i)).alias("grid"))

    def step(values: Column, _):
        def cell(r: Column) -> Column:
            moved = F.aggregate(
                r["moves"], F.lit(0.0), lambda acc, m: acc + m["n"] / r["total"] * F.element_at(values, m["dst"] + 1)
            )
            spread = F.when(r["total"] > 0, moved).otherwise(F.lit(0.0))
            return F.coalesce(r["own"] + r["stay"] * spread, F.lit(0.0))

        return F.transform("grid", cell)

    start = F.array_repeat(F.lit(0.0), CELLS)
    solved = one.select(F.aggregate(F.sequence(F.lit(1), F.lit(iterations)), start, step).alias("xt"))
    return solved.select(F.posexplode("xt").alias("cell", "xt"))


def xt_surface(edges: DataFrame, iterations: int = ITERATIONS) -> DataFrame:
    """xT per cell (``cell``, ``xt``), all 192 cells; zero where nothing happened."""
    return solve_cells(_cell_rows(edges), iterations)


def surface_table(surface: DataFrame) -> DataFrame:
    """Stored form: grid column, grid row and value with six digits."""
    return surface.select(
        (F.col("cell") % xy.GRID_COLS).alias("grid_col"), F.floor(F.col("cell") / xy.GRID_COLS).cast("int").alias("grid_row"),
        round_any(F.col("xt"), 6).alias("xt_value"),
    )


def lookup_cells(actions: DataFrame, surface: DataFrame) -> DataFrame:
    """Values of the start and end cell of every action.

    The surface becomes one row with an array of 192 values, a size fixed by the grid, and is planned once: both
    lookups index it.
    """
    joined = actions.crossJoin(F.broadcast(surface_array(surface)))
    value = {name: F.get("_surface", F.col(cell)) for name, cell in (("start_xt", "cell"), ("end_xt", "end_cell"))}
    return joined.withColumns(value).drop("_surface")


def surface_array(surface: DataFrame) -> DataFrame:
    """One row: the values of all cells by cell number."""
    cells = F.array_sort(F.collect_list(F.struct("cell", "xt")))
    return surface.agg(F.transform(cells, lambda e: e["xt"]).alias("_surface"))


def with_model_xt(events: DataFrame, surface: DataFrame, strict: bool = False) -> DataFrame:
    """Silver events with ``xt_value`` from the surface on the same row; null where an event has no value.

    The same values as :func:`event_xt`, without a join of events with events.
    """
    c = F.col
    start = xy.grid_cell(c("location_x"), c("location_y"))
    end = xy.grid_cell(c("end_location_x"), c("end_location_y"))
    placed = c("location_x").isNotNull() & c("location_y").isNotNull()
    at_start, at_end = F.get("_surface", start), F.get("_surface", end)
    value = F.when(placed & (c("event_type") == "Shot"), at_start).when(placed & completed_move(strict), at_end - at_start)
    joined = events.drop("xt_value").crossJoin(F.broadcast(surface_array(surface)))
    return joined.withColumn("xt_value", round_any(value, 6)).drop("_surface")


def event_xt(actions: DataFrame, surface: DataFrame) -> DataFrame:
    """xT per event: the cell's value for a shot, end minus start for a completed move; others are dropped."""
    c = F.col
    value = F.when(c("event_type") == "Shot", c("start_xt")).otherwise(c("end_xt") - c("start_xt"))
    valued = actions.where((c("event_type") == "Shot") | c("end_cell").isNotNull())
    scored = lookup_cells(valued, surface).withColumn("xt_value", round_any(value, 6))
    return scored.drop("start_xt", "end_xt", "cell", "end_cell", "outcome", "event_type")


def surface_to_matrix(surface: DataFrame) -> DataFrame:
    """One row per grid row with sixteen columns; a missing cell is zero."""
    wide = surface.groupBy("grid_row").pivot("grid_col", list(range(xy.GRID_COLS))).agg(F.first("xt_value"))
    cols = [F.coalesce(F.col(str(i)), F.lit(0.0)).alias(f"c{i}") for i in range(xy.GRID_COLS)]
    return wide.select("grid_row", *cols).orderBy("grid_row")


def normalise_to_max(surface: DataFrame, column: str = "xt_value") -> DataFrame:
    """Surface with each value as a share of the largest (null when that is zero)."""
    # An unpartitioned window is safe here: the surface has 192 rows.
    top = F.max(column).over(Window.partitionBy())
    return surface.withColumn("xt_normalised", round_any(ratio(F.col(column), top), 4))
