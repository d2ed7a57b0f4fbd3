"""Expected goals and expected passes: boosted trees, the first with sigmoid calibration over folds."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.operators.boosting import BoostedModel, TreeSettings, bin_edges, cell, train, train_shared
from touchline.operators.metrics import classifier_metrics
from touchline.plans.features import XG_FEATURES, XP_FEATURES
from touchline.session import materialise

log = logging.getLogger(__name__)

# Training bounds and tree settings.
AUC_FLOOR = 0.55
FEW_SHOTS = 50
MIN_PASSES = 500
TRAIN_SAMPLE = 300_000
ONE_TASK = 300_000  # passes that one task fits by itself; with more, all tasks share the fit
SEED = 42
HASH_BINS = 4096


XG_TREES = TreeSettings(trees=300, depth=4)
XP_TREES = TreeSettings(trees=400, depth=5)


class TrainingError(RuntimeError):
    """The data cannot carry a model."""


def hash_number(key: str, seed: int) -> Column:
    """A whole number below 2^52 fixed by the row's id, the same on every run, in every task and in any engine."""
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"/{seed}")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")


def hash_share(key: str, seed: int) -> Column:
    """The same as a number in [0, 1)."""
    return hash_number(key, seed) / F.lit(float(1 << 52))


def training_sample(rows: DataFrame, n: int = TRAIN_SAMPLE, key: str = "event_id", seed: int = SEED) -> DataFrame:
    """About ``n`` rows (all if there are fewer), drawn by id hash without a sort."""
    total = rows.count()
    return rows if total <= n else rows.where(hash_share(key, seed) < F.lit(n / total))


def split_parts(rows: DataFrame, label: str, test: float = 0.2, key: str = "event_id", seed: int = SEED) -> DataFrame:
    """Rows with a label and their ``part``: of each label the share ``test`` with the lowest hashes is the test part.

    The size of a label's test part is rounded down. The hash where it ends is found in a histogram, so only
    one bin of each label is ordered.
    """
    kept = rows.where(F.col(label).isNotNull()).withColumn("_hash", hash_number(key, seed + 1))
    return parts_by_hash(kept, label, test, key).select(*rows.columns, "part")


def parts_by_hash(kept: DataFrame, label: str, test: float, tie: str) -> DataFrame:
    """The ``part`` of rows with a label and a ``_hash``; of equal hashes the lowest ``tie`` comes first."""
    kept = materialise(kept.withColumn("_bin", F.expr(f"_hash div {(1 << 52) // HASH_BINS}")), "split")
    bins = kept.groupBy(F.col(label).alias("_label"), F.col("_bin").alias("_edge")).agg(F.count("*").alias("_n"))
    upto = Window.partitionBy("_label").orderBy("_edge").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("_label")
    bins = bins.withColumns({"_before": F.coalesce(F.sum("_n").over(upto), F.lit(0)),
                             "_wanted": F.floor(F.sum("_n").over(every) * F.lit(test))})
    edge = bins.where((F.col("_before") <= F.col("_wanted")) & (F.col("_before") + F.col("_n") > F.col("_wanted")))
    kept = kept.join(F.broadcast(edge.drop("_n")), F.col(label) == F.col("_label"))  # a row per label
    place = F.row_number().over(Window.partitionBy(label).orderBy("_hash", tie))
    inside = kept.where("_bin = _edge").withColumn("_test", F.col("_before") + place <= F.col("_wanted"))
    outside = kept.where("_bin <> _edge").withColumn("_test", F.col("_bin") < F.col("_edge"))
    return outside.unionByName(inside).withColumn("part", F.when(F.col("_test"), "test").otherwise("train"))


def stratified_split(
    rows: DataFrame, label: str, test: float = 0.2, key: str = "event_id", seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Train and test parts with the same share of every label and no row in both."""
    parts = materialise(split_parts(rows, label, test, key, seed), "parts")
    return tuple(parts.where(F.col("part") == name).drop("part") for name in ("train", "test"))


def stratified_folds(rows: DataFrame, label: str, folds: int, key: str = "event_id", seed: int = SEED) -> DataFrame:
    """``rows`` with a ``fold``: each label's rows are cut at the quantiles of their hash, so folds share it alike."""
    rows = rows.withColumn("_hash", hash_number(key, seed))
    cuts = [i / folds for i in range(1, folds)]
    edges = rows.groupBy(F.col(label).alias("_label")).agg(F.percentile_approx("_hash", cuts, 100_000).alias("_cuts"))
    joined = rows.join(F.broadcast(edges), F.col(label) == F.col("_label"))  # a row per label
    fold = F.size(F.filter("_cuts", lambda cut: cut < F.col("_hash")))
    return joined.withColumn("fold", fold).drop("_label", "_cuts", "_hash")


def train_xg(
    shots: DataFrame, settings: TreeSettings = XG_TREES, auc_floor: float = AUC_FLOOR, max_folds: int = 5
) -> tuple[BoostedModel, dict]:
    """Calibrated shot model and its metrics. ``shots`` is :func:`features.xg_features`.

    One ensemble per fold, trained on the other folds and calibrated on its own. Fails without shots, without goals, or
    when the model does not separate them. The ``holdout`` metrics are means over the folds of what an ensemble reaches,
    before calibration, on rows it has not seen; the other metrics are in-sample.
    """
    data = materialise(shots, "xg-training")
    size, goals = data.agg(F.count("*"), F.coalesce(F.sum("is_goal"), F.lit(0))).first()
    if size == 0:
        raise TrainingError("no shots to train on")
    if goals == 0:
        raise TrainingError("no goals among the shots")
    if size < FEW_SHOTS:
        log.warning("only %d shots: expected goals will be unreliable", size)
    folds = min(max_folds, max(2, int(goals)))
    model = train(stratified_folds(data, "is_goal", folds), XG_FEATURES, "is_goal", "fold", folds, settings, True, SEED)
    metrics = classifier_metrics(model.score(data, "xg_value"), "is_goal", "xg_value").first().asDict()
    report = {
        "roc_auc": metrics["auc"], "brier_score": metrics["brier_score"], "expected_goals": metrics["expected_positives"],
        "actual_goals": metrics["actual_positives"], "total_shots": metrics["n_rows"], "holdout_auc": model.mean("auc"),
        "holdout_log_loss": model.mean("log_loss"), "holdout_brier": model.mean("brier_score"),
    }
    if report["roc_auc"] is None or report["roc_auc"] < auc_floor:
        raise TrainingError(f"xG AUC {report['roc_auc']} is below {auc_floor}")
    return model, report


def score_xg(model: BoostedModel, shots: DataFrame) -> DataFrame:
    return model.score(shots, "xg_value").select("event_id", "xg_value")


def train_xp(passes: DataFrame, settings: TreeSettings = XP_TREES) -> tuple[BoostedModel | None, dict]:
    """Pass model and hold-out metrics; (None, {}) for fewer than 500 passes. It learns from every pass that is not held out."""
    size = passes.count()
    if size < MIN_PASSES:
        log.warning("only %d passes: no xP model", size)
        return None, {}
    if size <= ONE_TASK:
        data = materialise(passes, "xp-training")
        parts = materialise(split_parts(data, "target"), "xp-parts").withColumn("held", F.when(F.col("part") == "test", 0).otherwise(1))
        model = train(parts, XP_FEATURES, "target", "held", 1, settings, False, SEED)
    else:  # what is stored of a pass is the hash of its id and a byte for each feature
        known = passes.where(F.col("event_id").isNotNull() & F.col("target").isNotNull())
        edges = bin_edges(known, XP_FEATURES)
        coded = known.select("target", cell(XP_FEATURES, edges).alias("cell"), hash_number("event_id", SEED + 1).alias("_hash"))
        parts = parts_by_hash(coded, "target", 0.2, "cell").select("target", "cell", "part")
        model = train_shared(parts, XP_FEATURES, edges, "target", F.col("part") == "test", settings, SEED, size)
    row = model.rows[0]
    return model, {"auc": row["auc"], "log_loss": row["log_loss"], "train_size": row["n_train"], "test_size": row["n_held"]}


def score_xp(
    model: BoostedModel | None, passes: DataFrame, keep: Sequence[str] = (), scored: DataFrame | None = None
) -> DataFrame:
    """Completion probability of every pass with six digits; with ``scored``, only of passes it lacks.

    Without a model (too few passes to train one) there are no scores.
    """
    if model is None:
        return passes.select("event_id", *keep, F.lit(None).cast("double").alias("xp_value")).where(F.lit(False))
    rows = passes if scored is None else passes.join(
        scored.where(F.col("xp_value").isNotNull()).select("event_id"), "event_id", "left_anti"
    )
    return model.score(rows, "xp_value").select("event_id", *keep, "xp_value")


def needs_xp(passes: DataFrame, values: DataFrame) -> bool:
    """Whether any pass is still without a value."""
    done = values.where(F.col("xp_value").isNotNull()).select("event_id")
    return bool(passes.join(done, "event_id", "left_anti").head(1))


def save_model(spark: SparkSession, model: BoostedModel, path: str) -> None:
    model.save(spark, path)


def load_model(spark: SparkSession, path: str) -> BoostedModel:
    return BoostedModel.load(spark, path)
