"""Delivery and shot zones: K-Means on standardised start points, per event type."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from touchline.functions.coordinates import in_corner_arc
from touchline.functions.numeric import round_any
from touchline.operators import kmeans
from touchline.session import materialise

N_ZONES = 6
RESTARTS = 10
# Bounds of the iteration.
ITERATIONS, TOLERANCE = 300, 1e-4
SEED = 42
ZONE_TYPES = ("Corner", "Shot")
PLACE = ("location_x", "location_y")


def set_piece_points(silver: DataFrame) -> DataFrame:
    """Corner deliveries (passes from a corner box) and shots in one table."""
    cols = ("location_x", "location_y", "end_location_x", "end_location_y", "match_id", "team_id")
    placed = silver.where(F.col("location_x").isNotNull() & F.col("location_y").isNotNull())
    corner = (F.col("event_type") == "Pass") & in_corner_arc(F.col("location_x"), F.col("location_y"))
    corners = placed.where(corner).select("event_id", F.lit("Corner").alias("event_type"), *cols)
    shots = placed.where(F.col("event_type") == "Shot").select("event_id", "event_type", *cols)
    return corners.unionByName(shots)


def kmeans_zones(
    points: DataFrame, k: int = N_ZONES, restarts: int = RESTARTS, seed: int = SEED
) -> DataFrame:
    """Zone centres in metres with their member counts; a type with fewer than ``k`` rows is skipped.

    Equal points are merged into one weighted point first. Both types and all restarts are fitted together, a job a step,
    and the fit with the lowest cost wins. Labels follow the centres from left to right.
    """
    spark = points.sparkSession
    weighted = points.groupBy("event_type", *PLACE).agg(F.count("*").alias("weight"))
    weighted = materialise(weighted.where(F.col("event_type").isin(*ZONE_TYPES)), "zone-points")
    stats = {r["event_type"]: r for r in _weighted_scale(weighted).collect()}  # two rows
    enough = [kind for kind in ZONE_TYPES if kind in stats and stats[kind]["n"] >= k]
    fitted = [kind for kind in enough if stats[kind]["points"] > k]
    out = []
    for kind in enough:
        if kind in fitted:
            continue
        # No more distinct points than zones: every point is a centre and the rest stay empty.
        rows = weighted.where(F.col("event_type") == kind).collect()
        spots = sorted((r["location_x"], r["location_y"], r["weight"]) for r in rows)
        spots += [(*spots[0][:2], 0)] * (k - len(spots))
        out += [(kind, label, *spot) for label, spot in enumerate(spots)]
    if fitted:
        scaled = [
            F.round((F.col(c) - _of(stats, fitted, f"{c}_m")) / _of(stats, fitted, f"{c}_s") * F.lit(float(kmeans.UNIT)))
            .cast("bigint").alias(c) for c in PLACE
        ]
        grid = weighted.where(F.col("event_type").isin(*fitted)).select(F.col("event_type").alias("grp"), *scaled, "weight")
        grid = materialise(grid, "zone-grid")
        best = kmeans.fit(grid, PLACE, k, restarts, ITERATIONS, TOLERANCE, seed)
        for kind, fit in best.items():
            of = stats[kind]
            centres = [tuple(float(v) * of[f"{c}_s"] + of[f"{c}_m"] for v, c in zip(centre, PLACE)) for centre in fit.centres]
            order = sorted(range(k), key=lambda i: centres[i])
            out += [(kind, label, *centres[i], int(fit.members[i])) for label, i in enumerate(order)]
    table = spark.createDataFrame(
        out, "event_type string, cluster_label int, center_x double, center_y double, member_count bigint"
    )
    return table.withColumns({c: round_any(F.col(c), 2) for c in ("center_x", "center_y")})


def _weighted_scale(rows: DataFrame) -> DataFrame:
    """Per type: rows, distinct points, mean and population deviation of the rows (one in place of a zero deviation)."""
    w = F.col("weight")
    parts = []
    for c in PLACE:
        mean = F.sum(F.col(c) * w) / F.sum(w)
        square = F.sum(F.col(c) * F.col(c) * w) / F.sum(w)
        deviation = F.sqrt(F.greatest(square - mean * mean, F.lit(0.0)))
        # Nine digits: the last ones depend on the order of the sums.
        parts += [F.round(mean, 9).alias(f"{c}_m"), F.when(deviation > 1e-9, F.round(deviation, 9)).otherwise(1.0).alias(f"{c}_s")]
    return rows.groupBy("event_type").agg(F.sum(w).alias("n"), F.count("*").alias("points"), *parts)


def _of(stats: Mapping[str, Row], kinds: Sequence[str], name: str) -> Column:
    """A figure of the row's type."""
    return F.create_map(*[F.lit(x) for kind in kinds for x in (kind, stats[kind][name])])[F.col("event_type")]


def zone_checks(points: DataFrame, centres: DataFrame) -> DataFrame:
    """Per type: points, zones, members, and whether every centre is the mean of the points nearest to it.

    Nearness is taken on the standardised pitch, as the fit does; the centres are a dozen rows, so each point meets
    the few of its type.
    """
    c = F.col
    scale = points.groupBy("event_type").agg(*[
        F.when(F.stddev_pop(n) > 1e-9, F.stddev_pop(n)).otherwise(1.0).alias(f"_s{n[-1]}") for n in ("location_x", "location_y")
    ])
    place = F.struct("cluster_label", "center_x", "center_y", "member_count")
    sets = centres.groupBy("event_type").agg(F.collect_list(place).alias("_all"), F.sum("member_count").alias("n_members"),
                                             F.count("*").alias("n_zones"))
    joined = points.join(F.broadcast(sets), "event_type").join(F.broadcast(scale), "event_type")  # two rows each

    def away(z):
        return F.pow((c("location_x") - z["center_x"]) / c("_sx"), 2) + F.pow((c("location_y") - z["center_y"]) / c("_sy"), 2)

    nearest = F.array_min(F.transform("_all", lambda z: F.struct(away(z).alias("d"), z.alias("z"))))["z"]
    zoned = joined.withColumn("_zone", nearest).groupBy("event_type", "n_members", "n_zones", "_zone").agg(
        F.count("*").alias("_n"), F.avg("location_x").alias("_x"), F.avg("location_y").alias("_y")
    )
    # Points on a border may change sides when the centres are rounded to centimetres.
    off = F.greatest(F.abs(c("_x") - c("_zone.center_x")), F.abs(c("_y") - c("_zone.center_y")))
    return zoned.groupBy("event_type", "n_members", "n_zones").agg(
        F.sum("_n").alias("n_points"), (F.max(off) < 0.1).alias("centred")
    ).select("event_type", "n_points", "n_zones", "n_members", "centred")
