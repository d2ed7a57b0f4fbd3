"""Scaling statistics and classifier metrics, all from one aggregation each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.numeric import round_any, round_pos, to_units
from touchline.operators.running import running_sum


def scaler_statistics(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and population deviation per column, one row; a zero deviation becomes one."""
    parts = []
    for name in cols:
        deviation = F.stddev_pop(name)
        parts += [F.avg(name).alias(f"{name}_mean"), F.when(deviation > 0, deviation).otherwise(1.0).alias(f"{name}_std")]
    return df.agg(*parts)


def classifier_metrics(scored: DataFrame, label: str, probability: str, digits: int | None = 6) -> DataFrame:
    """AUC (ties count half), log loss, Brier score, expected and actual positives.

    Scores are taken with ``digits`` digits (at most six), so the score histogram has a bounded number of bins however
    many rows there are; the running count of negatives goes through blocks of a thousand bins each. With ``digits``
    None the scores stay as they are, and the histogram of distinct scores is ranked by range.
    """
    c = F.col
    p = F.least(F.greatest(c(probability).cast("double"), F.lit(0.0)), F.lit(1.0))
    if digits is None:
        return _exact_metrics(scored.select(c(label).cast("bigint").alias("y"), p.alias("p")))
    if digits < 6:
        p = round_pos(p, digits)
    hist = scored.groupBy(to_units(p, 6).alias("bin")).agg(
        F.sum(c(label).cast("bigint")).alias("pos"), F.count("*").alias("n")
    )
    hist = hist.withColumns({"neg": c("n") - c("pos"), "block": F.floor(c("bin") / 1000)})
    inside = Window.partitionBy("block").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    blocks = hist.groupBy("block").agg(F.sum("neg").alias("_neg"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("block", F.coalesce(F.sum("_neg").over(before), F.lit(0)).alias("_before"))
    # At most 1,001 rows.
    ranked = hist.withColumn("_inside", F.coalesce(F.sum("neg").over(inside), F.lit(0))).join(
        F.broadcast(blocks), "block"
    )
    value = c("bin") / F.lit(1e6)
    bounded = F.least(F.greatest(value, F.lit(1e-15)), F.lit(1 - 1e-15))
    loss = -(c("pos") * F.log(bounded) + c("neg") * F.log(1 - bounded))
    brier = c("pos") * (1 - value) * (1 - value) + c("neg") * value * value
    expected = F.sum(c("bin") * c("n")) / F.lit(1e6)
    return _summary(ranked, c("_before") + c("_inside"), expected, loss, brier)


def _summary(ranked: DataFrame, below: Column, expected: Column, loss: Column, brier: Column) -> DataFrame:
    """One row of metrics from ``pos, neg, n`` per score and the negatives with a lower score."""
    c = F.col
    # Pairs of positives and negatives pass the range of a bigint at a few billion of each.
    wide = "decimal(19,0)"
    wins = c("pos").cast(wide) * (2 * below + c("neg")).cast(wide)
    total = F.sum("n").cast("double")
    return ranked.agg(
        F.sum(wins).alias("_wins"), F.sum("pos").alias("actual_positives"), F.sum("neg").alias("_neg"),
        F.sum("n").alias("n_rows"), round_pos(expected, 2).alias("expected_positives"),
        round_any(F.sum(loss) / total, 4).alias("log_loss"), round_pos(F.sum(brier) / total, 4).alias("brier_score"),
    ).select(
        round_pos(F.try_divide(c("_wins").cast("double"), 2.0 * c("actual_positives") * c("_neg")), 4).alias("auc"),
        "log_loss", "brier_score", "expected_positives", "actual_positives", "n_rows",
    )


def _exact_metrics(rows: DataFrame) -> DataFrame:
    c = F.col
    hist = rows.groupBy("p").agg(F.sum("y").alias("pos"), F.count("*").alias("n")).withColumn("neg", c("n") - c("pos"))
    ranked = running_sum(hist, [], [c("p").asc()], c("neg"), "_upto")
    bounded = F.least(F.greatest(c("p"), F.lit(1e-15)), F.lit(1 - 1e-15))
    loss = -(c("pos") * F.log(bounded) + c("neg") * F.log(1 - bounded))
    brier = c("pos") * (1 - c("p")) * (1 - c("p")) + c("neg") * c("p") * c("p")
    return _summary(ranked, c("_upto") - c("neg"), F.sum(c("p") * c("n")), loss, brier)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, one row each."""
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("entity"), "n") for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.orderBy("entity")


