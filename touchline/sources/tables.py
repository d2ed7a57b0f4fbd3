"""Stored tables: keyed writes without a table format.

Parquet has no row update. A keyed write is therefore an anti join plus an append (insert-or-ignore) or a
rewrite of the small table it concerns (upsert). Model values live in a side table keyed by event, so the
fact table is never rewritten. One writer per table is assumed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline import schemas
from touchline.functions.labels import fixed

EVENT_KEYS = ("event_id", "competition_id")
# The views that may be refreshed by name.
REFRESHABLE = ("mv_team_xg", "mv_shot_locations")


# --- keyed set operations on DataFrames -------------------------------------------------------------------


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the smallest by ``order``, nulls last, then the one with the fewest nulls, then by a hash.

    Only narrow columns are ordered, never a payload, and the filter sits right on the row number: each task keeps one
    row per key before the shuffle, so a key with very many copies does not travel whole to one task.
    """
    rest = [name for name in df.columns if name not in keys]
    if not rest:
        return df.select(*keys).distinct()
    missing = reduce(lambda a, b: a + b, [F.col(name).isNull().cast("int") for name in rest])
    hashed = df.withColumns({"_hash": F.xxhash64(*rest), "_missing": missing})
    ordered = Window.partitionBy(*keys).orderBy(*[F.col(name).asc_nulls_last() for name in order or ()], "_missing", "_hash")
    return hashed.withColumn("_place", F.row_number().over(ordered)).where("_place = 1").select(*df.columns)


def keyed(batch: DataFrame, keys: Sequence[str] = EVENT_KEYS) -> DataFrame:
    """Rows with a whole key. A null key equals no stored key, so every replay would add such a row again."""
    return batch.where(reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in keys]))


def new_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str] = EVENT_KEYS) -> DataFrame:
    """Rows of ``batch`` whose key the target does not hold, one per key; rows without a whole key are refused."""
    return first_per_key(keyed(batch, keys), keys).join(target.select(*keys), list(keys), "left_anti")


def append_new(target: DataFrame, batch: DataFrame, keys: Sequence[str] = EVENT_KEYS) -> DataFrame:
    """Insert-or-ignore: the target after the batch was offered to it."""
    return target.unionByName(new_rows(target, batch, keys).select(*target.columns))


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Update-or-insert: rows of ``batch`` replace rows of the target with the same key."""
    fresh = first_per_key(batch, keys)
    return target.join(fresh.select(*keys), list(keys), "left_anti").unionByName(fresh.select(*target.columns))


def dimension_rows(events: DataFrame, key: str, cols: dict[str, Column]) -> DataFrame:
    """Dimension members seen in a batch of events: one row per non-null key."""
    seen = events.where(F.col(key).isNotNull()).select(key, *[value.alias(name) for name, value in cols.items()])
    return first_per_key(seen, [key], list(cols))


def upsert_dimension(target: DataFrame, events: DataFrame, key: str, cols: dict[str, Column]) -> DataFrame:
    """The dimension with the members it lacked; known members stay as they are."""
    return append_new(target, dimension_rows(events, key, cols), [key])


def filter_in(df: DataFrame, column: str, values: Sequence | DataFrame) -> DataFrame:
    """Keep rows whose value is in a short list, or in the single column of a DataFrame."""
    if isinstance(values, DataFrame):
        return df.join(values.select(F.col(values.columns[0]).alias(column)), column, "left_semi")
    return df.where(F.col(column).isin(*values))


def pending_matches(matches: DataFrame, ledger: DataFrame, competitions: Sequence[int] | None = None) -> DataFrame:
    """Matches still to load: everything not recorded as a success, so errors are retried."""
    wanted = matches if competitions is None else filter_in(matches, "competition_id", competitions)
    return wanted.join(ledger.where(F.col("status") == "success").select("match_id"), "match_id", "left_anti")


def mark_ingested(ledger: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Ledger after recording outcomes. A known match keeps its first competition and event count."""
    known = ledger.select("match_id", *[F.col(c).alias(f"_{c}") for c in ("competition_id", "event_count")])
    fresh = first_per_key(outcomes, ["match_id"]).join(known, "match_id", "left")
    kept = F.col("_competition_id").isNotNull()
    updated = fresh.select(
        "match_id",
        F.when(kept, F.col("_competition_id")).otherwise(F.col("competition_id")).alias("competition_id"),
        F.when(kept, F.col("_event_count")).otherwise(F.col("event_count")).alias("event_count"),
        *[c for c in ledger.columns if c not in ("match_id", "competition_id", "event_count")],
    )
    return upsert(ledger, updated, ["match_id"])


def event_values(events: DataFrame) -> DataFrame:
    """Side table of model values for the events that have any."""
    some = F.coalesce("xt_value", "xp_value", "xg_value").isNotNull()
    return events.where(some).select(*EVENT_KEYS, "xt_value", "xp_value", "xg_value")


def write_event_values(values: DataFrame, scored: DataFrame, column: str) -> DataFrame:
    """Side table after a model wrote ``column``; the other two values of an event are kept."""
    others = [c for c in ("xt_value", "xp_value", "xg_value") if c != column]
    joined = values.withColumnRenamed(column, "_old").join(
        scored.select(*EVENT_KEYS, F.col(column).alias("_new"), F.lit(True).alias("_scored")), list(EVENT_KEYS), "full"
    )
    fresh = F.when(F.col("_scored"), F.col("_new")).otherwise(F.col("_old")).alias(column)
    return joined.select(*EVENT_KEYS, *others, fresh).select(*EVENT_KEYS, "xt_value", "xp_value", "xg_value")


def with_event_values(df: DataFrame, values: DataFrame, how: str = "left") -> DataFrame:
    """Attach model values by event key: id and competition, where both sides have it."""
    on = [key for key in EVENT_KEYS if key in df.columns and key in values.columns]
    kept = df.drop("xt_value", "xp_value", "xg_value")
    return kept.join(values, on, how)


# --- files ------------------------------------------------------------------------------------------------


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Fact table with every declared column; files from before provenance columns get their defaults."""
    # The declared schema spares a pass over every file footer; a column a file lacks reads as null.
    return with_provenance(spark.read.schema(schemas.EVENT).parquet(path).select(*schemas.EVENT.fieldNames()))


def with_provenance(events: DataFrame) -> DataFrame:
    """Events with the defaults of columns that older files lack."""
    defaults = {"provider": F.lit("statsbomb"), "coord_system": F.lit("statsbomb_120x80"), "under_pressure": F.lit(False)}
    return events.withColumns({name: F.coalesce(F.col(name), value) for name, value in defaults.items()})


def write_partitioned(
    df: DataFrame, path: str, mode: str = "append", known_competitions: Sequence[int] | None = None,
    watch: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """One folder per competition, so that a filter on ``competition_id`` reads only its folders.

    With ``known_competitions`` the folder column is ``competition`` and all other competitions share the folder
    ``default``. Rows are gathered by competition and match; the rebalance splits whatever is too large for one
    task, be it one competition or one match, and merges what is too small for a file of its own. Files are sorted,
    so that match and type filters skip row groups. ``watch`` sees the rows in the stage that writes them.
    """
    folder = "competition_id"
    if known_competitions is not None:
        folder = "competition"
        known = F.col("competition_id").isin(*known_competitions)
        df = df.withColumn(folder, F.when(known, F.col("competition_id").cast("string")).otherwise("default"))
    gathered = df.hint("rebalance", folder, "match_id")
    (
        (watch(gathered) if watch else gathered).sortWithinPartitions(folder, "match_id", "event_type")
        .write.mode(mode).partitionBy(folder).parquet(path)
    )


def append_events(spark: SparkSession, batch: DataFrame, path: str) -> None:
    """Insert-or-ignore into the stored fact table; rows without a whole key are refused.

    Stored keys are first narrowed to the batch's matches, so a batch of a few matches is compared with their events
    only, and the competitions of the batch prune the folders that are read.
    """
    if table_exists(spark, path):
        stored = spark.read.schema(schemas.EVENT).parquet(path).select(*EVENT_KEYS, "match_id")
        near = batch.select("competition_id", "match_id").distinct()
        batch = new_rows(stored.join(near, ["competition_id", "match_id"], "left_semi"), batch)
    else:
        batch = first_per_key(keyed(batch), EVENT_KEYS)
    write_partitioned(batch, path)


def write_bucketed(
    df: DataFrame, name: str, path: str, keys: Sequence[str] = EVENT_KEYS, buckets: int | None = None
) -> DataFrame:
    """A catalog table over ``path`` whose rows lie in buckets of their key, sorted within them, and the table itself.

    Tables with the same keys and number of buckets join, merge and aggregate by these keys without moving a stored row:
    the one shuffle is paid at the write. A bucket is one task of such a join, so there should be enough of them for a
    bucket to fit in memory; by default there are as many as shuffle partitions (with fewer, Spark spreads them anew to use its tasks). The keys should be unique, or nearly so.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartition(n, *keys)  # a file per bucket
    rows.write.mode("overwrite").format("parquet").option("path", path).bucketBy(n, *keys).sortBy(*keys).saveAsTable(name)
    return spark.table(name)


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Truncate and insert. The new rows are staged first, so ``df`` may read the table it replaces.

    The old table is moved aside, the new one moved in, and the old one deleted last: a crash leaves one of the two
    whole, and the next call moves an old one back that has no successor.
    """
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    base = path.rstrip("/")
    source, aside, target = (
        jvm.org.apache.hadoop.fs.Path(name) for name in (f"{base}__staging_{uuid.uuid4().hex}", f"{base}__replaced", base)
    )
    fs = target.getFileSystem(conf)
    if fs.exists(aside) and not fs.exists(target):
        fs.rename(aside, target)
    df.write.parquet(source.toString())
    fs.delete(aside, True)
    if fs.exists(target) and not fs.rename(target, aside):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(source, target):
        fs.rename(aside, target)
        raise OSError(f"could not move {source.toString()} to {path}")
    fs.delete(aside, True)
    spark.catalog.refreshByPath(path)
    return spark.read.schema(df.schema).parquet(path)


def refresh(name: str, df: DataFrame, folder: str) -> DataFrame:
    """Rebuild one of the stored views; other names are refused."""
    if name not in REFRESHABLE:
        raise ValueError(f"not a refreshable view: {name}")
    return replace_table(df, f"{folder.rstrip('/')}/{name}")


# --- model registry ---------------------------------------------------------------------------------------


def register_model(
    spark: SparkSession, path: str, name: str, version: str, metrics: dict, artifact: str | None = None
) -> None:
    """Append one registry row; the metrics are kept as a JSON document."""
    import json

    row = spark.createDataFrame([(name, version, json.dumps(metrics), artifact)],
                                "model_name string, version string, metrics string, artifact_path string")
    row = row.withColumn("trained_at", F.current_timestamp()).select(*schemas.REGISTRY.fieldNames())
    row.coalesce(1).write.mode("append").parquet(path)


def model_history(registry: DataFrame, keys: Sequence[str] = ("auc", "log_loss", "train_size")) -> DataFrame:
    """Registry with the chosen metrics as text columns, newest first."""
    metrics = [F.get_json_object("metrics", f"$.{key}").alias(key) for key in keys]
    return registry.select("model_name", "version", "trained_at", *metrics).orderBy(F.desc("trained_at"))


# --- documents --------------------------------------------------------------------------------------------


def to_json_docs(df: DataFrame, key: str) -> DataFrame:
    """One JSON document per row next to its key."""
    return df.select(key, F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("document"))


def clip_documents(clips: DataFrame, description: str = "Top xT offensive actions") -> DataFrame:
    """One XML document per match: ``match_id, document``.

    ``clips`` has the columns match_id, rank, start_ms, end_ms, code, label and the clip columns of the report. A match
    has at most as many clips as the report asks for, so a document is small.
    """
    c = F.col

    def text(value: Column) -> Column:
        for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            value = F.replace(value, F.lit(sign), F.lit(name))
        return value

    def element(name: str, value: Column) -> Column:
        whole = F.concat(F.lit(f"<{name}>"), text(value.cast("string")), F.lit(f"</{name}>"))
        return F.coalesce(whole, F.lit(""))  # nothing for a missing value

    def number(name: str, digits: int) -> Column:
        return F.when(c(name).isNotNull(), fixed(c(name), digits))

    # The element names of the importer.
    label = [
        element("text", c("label")), element("pos_x", number("location_x", 2)), element("pos_y", number("location_y", 2)),
        element("end_pos_x", number("end_location_x", 2)), element("end_pos_y", number("end_location_y", 2)),
        element("xt_value", number("xt_value", 6)), element("xg_value", number("xg_value", 6)),
        element("minute", c("minute")), element("second", c("second")),
        element("player", F.coalesce("player_name", F.lit("Unknown"))), element("team", F.coalesce("team_name", F.lit("Unknown"))),
        element("event_type", c("event_type")),
    ]
    instance = F.concat(
        F.lit("<instance>"), element("ID", c("rank")), element("start", c("start_ms")), element("end", c("end_ms")),
        element("code", c("code")), F.lit("<label>"), *label, F.lit("</label></instance>"),
    )
    ordered = F.array_sort(F.collect_list(F.struct(c("rank"), instance.alias("xml"))))
    one = clips.groupBy("match_id").agg(ordered.alias("_all"))
    document = F.concat(
        F.lit("<file><ALL_INSTANCES>"), F.array_join(F.transform("_all", lambda e: e["xml"]), ""), F.lit("</ALL_INSTANCES><SEQUENCE>"),
        element("description", F.lit(description)), element("action_count", F.size("_all")), F.lit("</SEQUENCE></file>"),
    )
    return one.select("match_id", document.alias("document"))


def write_clips_xml(clips: DataFrame, path: str, description: str = "Top xT offensive actions") -> None:
    """The clip documents as files, one folder with one document per match."""
    documents = clip_documents(clips, description).repartition("match_id")
    documents.write.mode("overwrite").partitionBy("match_id").option("lineSep", "\n").text(path)
