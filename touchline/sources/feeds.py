"""Provider feeds to canonical events.

Each reader takes a path, directory or glob with one JSON document per match; the match id is the number in
the file name. The mapping functions work on batch and streaming DataFrames alike.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline import schemas

# Event names of the second feed's numeric type ids.
OPTA_TYPES = {
    1: "Pass", 2: "Offside Pass", 3: "Take On", 4: "Foul", 5: "Out", 6: "Corner Awarded", 7: "Tackle",
    8: "Interception", 9: "Turnover", 10: "Save", 11: "Claim", 12: "Clearance", 13: "Miss", 14: "Post",
    15: "Attempt Saved", 16: "Shot", 17: "Goal", 18: "Card", 19: "Player Off", 20: "Player On",
    35: "Clearance Off Line", 41: "Ball Recovery", 49: "Ball Touch", 50: "Carry", 54: "High Press",
    61: "Chance Missed", 74: "Keeper Sweeper",
}

# Event names of the third feed's primary types.
WYSCOUT_TYPES = {
    "pass": "Pass", "shot": "Shot", "dribble": "Carry", "carry": "Carry", "clearance": "Clearance",
    "foul": "Foul", "duel": "Duel", "interception": "Interception", "pressure": "Pressure",
    "touch": "Ball Touch", "blocked_shot": "Block", "goal_kick": "Goal Kick", "corner": "Corner",
    "throw_in": "Throw In", "free_kick": "Free Kick", "offside": "Offside",
    "goalkeeper_reflex": "Goalkeeper Save",
}

# Fixed value: the qualifier that marks an action under pressure.
OPTA_PRESSURE_QUALIFIER = 72


def _lookup(table: dict, key: Column) -> Column:
    """Value for a key of a small fixed table; 'Unknown' for any other key."""
    entries = F.create_map(*[F.lit(part) for pair in table.items() for part in pair])
    return F.coalesce(F.get(F.transform(F.array(key), lambda k: entries[k]), F.lit(0)), F.lit("Unknown"))


def _match_id_from_file(path: Column | None = None) -> Column:
    """The first number of the file's name that stands alone (``f24-7`` is match 7), else the first one.

    Null for a name without a number, or with one that is no int.
    """
    name = F.element_at(F.split(F.col("_metadata.file_path") if path is None else path, "/"), -1)
    alone = F.nullif(F.regexp_extract(name, r"(?<![A-Za-z\d])(\d+)(?![A-Za-z\d])", 1), F.lit(""))
    return F.coalesce(alone, F.regexp_extract(name, r"(\d+)", 1)).try_cast("int")


def payload_of(raw: DataFrame, event: Column) -> Column:
    """The event as delivered, where the reader kept it; else its declared fields."""
    return F.col("payload") if "payload" in raw.columns else F.to_json(event)


def _canonical(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.FEED_EVENT.fields])


def _fallback_id(match_id: Column, minute: Column, second: Column) -> Column:
    """Id of an event without one: match, minute and second. A missing part is written as ``null``."""
    parts = [F.coalesce(part.cast("string"), F.lit("null")) for part in (match_id, minute, second)]
    return F.concat_ws("_", *parts)


def map_statsbomb(raw: DataFrame, competition_id: int = 0) -> DataFrame:
    """Rows with the feed columns and ``match_id`` to canonical events."""
    c = F.col
    end = F.coalesce(c("pass.end_location"), c("carry.end_location"), c("shot.end_location"))
    body = F.struct(*[c(f.name) for f in schemas.STATSBOMB_FEED.fields])
    return _canonical(
        raw.select(
            c("id").alias("event_id"), "match_id", F.lit(competition_id).alias("competition_id"),
            c("team.id").alias("team_id"), c("player.id").alias("player_id"),
            F.coalesce(c("type.name"), F.lit("Unknown")).alias("event_type"),
            F.coalesce("minute", F.lit(0)).alias("minute"), F.coalesce("second", F.lit(0)).alias("second"),
            F.get("location", F.lit(0)).alias("location_x"), F.get("location", F.lit(1)).alias("location_y"),
            F.get(end, F.lit(0)).alias("end_location_x"), F.get(end, F.lit(1)).alias("end_location_y"),
            F.coalesce("pass.outcome.name", "shot.outcome.name", "duel.outcome.name", F.lit("Unknown"))
            .alias("outcome"),
            F.coalesce("under_pressure", F.lit(False)).alias("under_pressure"),
            F.lit("statsbomb").alias("provider"), F.lit("statsbomb_120x80").alias("coord_system"),
            payload_of(raw, body).alias("raw_json"),
        )
    )


def map_opta(raw: DataFrame, competition_id: int = 0) -> DataFrame:
    """Rows with an event ``e`` and ``match_id`` to canonical events."""
    c, flat = F.col, raw
    pressed = F.exists(
        F.coalesce("e.Qualifiers", F.array()), lambda q: q["QualifierId"] == F.lit(OPTA_PRESSURE_QUALIFIER)
    )
    return _canonical(
        flat.select(
            F.coalesce(c("e.EventId").cast("string"), _fallback_id(c("match_id"), c("e.Min"), c("e.Sec")))
            .alias("event_id"),
            "match_id", F.lit(competition_id).alias("competition_id"),
            c("e.TeamId").alias("team_id"), c("e.PlayerId").alias("player_id"),
            _lookup(OPTA_TYPES, F.coalesce("e.TypeId", F.lit(0))).alias("event_type"),
            F.coalesce("e.Min", F.lit(0)).alias("minute"), F.coalesce("e.Sec", F.lit(0)).alias("second"),
            c("e.X").alias("location_x"), c("e.Y").alias("location_y"),
            c("e.EndX").alias("end_location_x"), c("e.EndY").alias("end_location_y"),
            F.when(c("e.Outcome") == 1, "Unknown").otherwise("Fail").alias("outcome"),
            F.coalesce(pressed, F.lit(False)).alias("under_pressure"),
            F.lit("opta").alias("provider"), F.lit("opta_100x100").alias("coord_system"),
            payload_of(raw, c("e")).alias("raw_json"),
        )
    )


def map_wyscout(raw: DataFrame, competition_id: int = 0) -> DataFrame:
    """Rows with an event ``e`` and ``match_id`` to canonical events."""
    c, flat = F.col, raw
    outcome = (
        F.when(c("e.pass").isNotNull(), F.when(c("e.pass.accurate"), "Success").otherwise("Fail"))
        .when(c("e.shot.isGoal"), "Goal")
        .when(c("e.shot.onTarget"), "Saved")
        .when(c("e.shot").isNotNull(), "Off Target")
        .otherwise("Unknown")
    )
    end = F.coalesce("e.pass.endLocation", "e.shot.endLocation", "e.carry.endLocation")
    tags = F.coalesce("e.type.secondary", F.array().cast("array<string>"))
    return _canonical(
        flat.select(
            F.coalesce(c("e.id").cast("string"), _fallback_id(c("match_id"), c("e.minute"), c("e.second")))
            .alias("event_id"),
            "match_id", F.lit(competition_id).alias("competition_id"),
            c("e.team.id").alias("team_id"), c("e.player.id").alias("player_id"),
            _lookup(WYSCOUT_TYPES, F.coalesce("e.type.primary", F.lit(""))).alias("event_type"),
            F.coalesce("e.minute", F.lit(0)).alias("minute"), F.coalesce("e.second", F.lit(0)).alias("second"),
            c("e.location.x").alias("location_x"), c("e.location.y").alias("location_y"),
            end["x"].alias("end_location_x"), end["y"].alias("end_location_y"),
            outcome.alias("outcome"),
            F.coalesce(F.array_contains(tags, "under_pressure"), F.lit(False)).alias("under_pressure"),
            F.lit("wyscout").alias("provider"), F.lit("wyscout_100x100").alias("coord_system"),
            payload_of(raw, c("e")).alias("raw_json"),
        )
    )


def _event_schema(feed: T.StructType, member: str | None) -> T.StructType:
    return feed if member is None else feed[member].dataType.elementType


# Per provider the member of the document that lists the events (None: the document is the list) and their mapping.
FEEDS = {
    "statsbomb": (schemas.STATSBOMB_FEED, None, map_statsbomb),
    "opta": (schemas.OPTA_FEED, "Events", map_opta),
    "wyscout": (schemas.WYSCOUT_FEED, "events", map_wyscout),
}


def documents(files: DataFrame, provider: str, match_id: int | None = None) -> DataFrame:
    """``match_id, file, error, events`` of whole-text files; ``events`` are JSON texts as delivered.

    ``error`` says why a file cannot be loaded: its JSON is broken, or no match id is known. Such a file has no events.
    """
    _, member, _ = FEEDS[provider]
    number = _match_id_from_file() if match_id is None else F.lit(match_id)
    listed = F.from_json("value", "array<string>") if member is None else F.from_json("value", f"{member} array<string>")[member]
    whole = files.select(number.alias("match_id"), F.col("_metadata.file_path").alias("file"), "value")
    broken = F.try_parse_json("value").isNull() | F.col("value").rlike(r"^\s*$")
    error = F.when(broken, "broken JSON").when(F.col("match_id").isNull(), "no match id in the file name")
    events = F.when(error.isNull(), F.coalesce(listed, F.array().cast("array<string>")))
    return whole.select("match_id", "file", error.alias("error"), events.alias("events"))


def map_documents(docs: DataFrame, provider: str, competition_id: int = 0) -> DataFrame:
    """Canonical events of :func:`documents`, each with its payload as delivered."""
    feed, member, mapper = FEEDS[provider]
    flat = docs.select("match_id", F.explode("events").alias("payload"))
    parsed = flat.withColumn("e", F.from_json("payload", _event_schema(feed, member)))
    return mapper(parsed.select("match_id", "payload", "e.*") if member is None else parsed, competition_id)


def _files(reader, path: str) -> DataFrame:
    return reader.option("wholetext", True).text(path)


def read_feed(
    spark: SparkSession, provider: str, path: str, competition_id: int = 0, match_id: int | None = None
) -> DataFrame:
    """Canonical events of one provider's files; a broken file gives none. An unknown provider is an error."""
    if provider not in FEEDS:
        raise ValueError(f"Unknown provider: {provider}")
    return map_documents(documents(_files(spark.read, path), provider, match_id), provider, competition_id)


def read_statsbomb(spark: SparkSession, path: str, competition_id: int = 0, match_id: int | None = None) -> DataFrame:
    return read_feed(spark, "statsbomb", path, competition_id, match_id)


def read_opta(spark: SparkSession, path: str, competition_id: int = 0, match_id: int | None = None) -> DataFrame:
    return read_feed(spark, "opta", path, competition_id, match_id)


def read_wyscout(spark: SparkSession, path: str, competition_id: int = 0, match_id: int | None = None) -> DataFrame:
    return read_feed(spark, "wyscout", path, competition_id, match_id)


def stream_documents(spark: SparkSession, provider: str, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Files as they arrive, see :func:`documents`."""
    return documents(_files(spark.readStream.option("maxFilesPerTrigger", files_per_batch), path), provider)


def files_of(spark: SparkSession, path: str, matches: DataFrame) -> list[str]:
    """Paths of the files whose name gives one of the ``match_id`` of ``matches``; only names are read, no contents."""
    names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    found = names.select("path", _match_id_from_file(F.col("path")).alias("match_id"))
    return [r["path"] for r in found.join(matches.select("match_id"), "match_id", "left_semi").orderBy("path").collect()]


def union_providers(*parts: DataFrame) -> DataFrame:
    """One stream of events; a column missing from a part is null there."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)


def _field_or_self(df: DataFrame, name: str) -> Column:
    """``name.name`` of a struct column, the column itself when it is already text."""
    kind = df.schema[name].dataType.typeName()
    return F.col(f"{name}.name") if kind == "struct" else F.col(name)


def _column_or_null(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def flatten_events(df: DataFrame, match_id: int, competition_id: int) -> DataFrame:
    """Pre-flattened bulk events (``pass_end_location``, ``pass_outcome``, ...) to canonical events.

    Unlike the feed mapping, an event without any outcome keeps a null outcome. Identical inputs get the same
    generated ids on a retry, because a missing id is derived from the row, not drawn at random.
    """
    c = F.col

    def point(name: str) -> Column:
        value = _column_or_null(df, name, "array<double>")
        return F.when(F.size(value) >= 2, value)

    end = F.coalesce(*[point(f"{kind}_end_location") for kind in ("pass", "carry", "shot")])
    outcome = F.coalesce(
        *[_column_or_null(df, f"{kind}_outcome", "string") for kind in ("pass", "shot", "duel", "clearance")]
    )
    whole_row = F.to_json(F.struct(*[c(name) for name in df.columns]))
    digest = F.md5(whole_row)
    made_id = F.concat_ws(
        "-", *[F.substring(digest, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    )
    location = _column_or_null(df, "location", "array<double>")
    return df.select(
        F.coalesce(c("id").cast("string"), made_id).alias("event_id"),
        F.lit(match_id).alias("match_id"), F.lit(competition_id).alias("competition_id"),
        _column_or_null(df, "team_id", "int").alias("team_id"),
        _column_or_null(df, "player_id", "int").alias("player_id"),
        _field_or_self(df, "type").alias("event_type"),
        c("minute").cast("smallint").alias("minute"), c("second").cast("smallint").alias("second"),
        F.get(location, F.lit(0)).alias("location_x"), F.get(location, F.lit(1)).alias("location_y"),
        F.get(end, F.lit(0)).alias("end_location_x"), F.get(end, F.lit(1)).alias("end_location_y"),
        outcome.alias("outcome"),
        F.coalesce(_column_or_null(df, "under_pressure", "boolean"), F.lit(False)).alias("under_pressure"),
        F.lit("statsbomb").alias("provider"), F.lit("statsbomb_120x80").alias("coord_system"),
        F.lit(None).cast("double").alias("xt_value"), F.lit(None).cast("double").alias("xp_value"),
        F.lit(None).cast("double").alias("xg_value"), whole_row.alias("raw_json"),
    )
