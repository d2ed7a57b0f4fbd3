"""Running sums and ranks over partitions of any size.

A plain window sorts each partition in one task. Here rows are range-partitioned by (partition, order), each
range gets a local window, and the totals of the earlier ranges of the same partition are added. Only
partitions that span several ranges need an offset, so the offset table has fewer rows than there are ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.session import materialise


def running_sum(
    df: DataFrame, partition: Sequence[str], order: Sequence[Column], units: Column, out: str,
    ranges: int | None = None,
) -> DataFrame:
    """Add ``out``: the sum of the whole-number column ``units`` from the partition's first row to this one.

    ``order`` must be total within a partition (end it with a unique id).
    """
    keys = list(partition)
    prepared = df.withColumn("_rs_units", units)
    keyed = [F.col(k).asc_nulls_first() for k in keys] + list(order)
    spread = prepared.repartitionByRange(ranges, *keyed) if ranges else prepared.repartitionByRange(*keyed)
    # Written out so that the rows and the totals below see the same range boundaries.
    rows = materialise(spread.withColumn("_rs_range", F.spark_partition_id()), "ranges")

    local = Window.partitionBy(*keys, "_rs_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_rs_local", F.sum("_rs_units").over(local))

    totals = rows.groupBy(*keys, "_rs_range").agg(F.sum("_rs_units").alias("_rs_total"))
    earlier = Window.partitionBy(*keys).orderBy("_rs_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_rs_offset", F.sum("_rs_total").over(earlier)).where(F.col("_rs_offset").isNotNull())
    side = offsets.select(F.col("_rs_range").alias("_rs_r"), *[F.col(k).alias(f"_rs_k_{k}") for k in keys], "_rs_offset")
    on = F.col("_rs_range") == F.col("_rs_r")
    for key in keys:
        on = on & F.col(key).eqNullSafe(F.col(f"_rs_k_{key}"))
    # At most one row per range boundary, so this broadcast is bounded by the number of shuffle partitions.
    joined = rows.join(F.broadcast(side), on, "left")
    total = F.col("_rs_local") + F.coalesce("_rs_offset", F.lit(0).cast("bigint"))
    drop = ["_rs_units", "_rs_range", "_rs_local", "_rs_r", "_rs_offset", *[f"_rs_k_{k}" for k in keys]]
    return joined.withColumn(out, total).drop(*drop)


def rank_rows(df: DataFrame, partition: Sequence[str], sort_units: str, out: str) -> DataFrame:
    """Add ``out``: the rank of each row within its partition, largest ``sort_units`` first, ties sharing it, nulls first.

    Equal values collapse to one row with their number before anything is ordered, so a value that fills a partition costs
    one row; ranks are running sums of these numbers. The join that brings them back to the rows has one row per value on
    its other side, so a hot value can be split.
    """
    keys = list(partition)
    rows = materialise(df, "ranked")
    values = rows.groupBy(*keys, sort_units).agg(F.count(F.lit(1)).alias("_rk_n"))
    summed = running_sum(values, keys, [F.col(sort_units).desc_nulls_first()], F.col("_rk_n"), "_rk_upto")
    rank = (F.col("_rk_upto") - F.col("_rk_n") + 1).cast("int").alias(out)
    ranks = summed.select(*(F.col(k).alias(f"_rk_{k}") for k in (*keys, sort_units)), rank)
    on = F.lit(True)
    for k in (*keys, sort_units):
        on = on & F.col(k).eqNullSafe(F.col(f"_rk_{k}"))
    return rows.join(ranks, on).drop(*(f"_rk_{k}" for k in (*keys, sort_units)))


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, out: str = "rank") -> DataFrame:
    """First ``k`` rows of every group, numbered from 1.

    The filter sits right on the row number, so Spark keeps only ``k`` rows per group and task before the
    shuffle and a hot group stays small.
    """
    numbered = df.withColumn(out, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return numbered.where(F.col(out) <= k)


def top_rows(df: DataFrame, order: Sequence[Column], k: int, out: str = "rank") -> DataFrame:
    """The ``k`` first rows of the whole table, numbered from 1."""
    best = df.orderBy(*order).limit(k)
    return best.withColumn(out, F.row_number().over(Window.orderBy(*order)))


def order_nulls_last(df: DataFrame, column: str, *ties: str) -> DataFrame:
    return df.orderBy(F.col(column).desc_nulls_last(), *ties)


def order_by_abs(df: DataFrame, column: str, *ties: str) -> DataFrame:
    return df.orderBy(F.abs(column).desc(), *ties)


def limit_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """A fixed number of rows, in id order so that repeated runs agree."""
    return df.orderBy(*order).limit(n)
