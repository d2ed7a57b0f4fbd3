"""Tables that change together, and views that read only what is new.

A publication writes its rows into folders of their own and then one small list that names the folders of every table.
Readers go by the newest list, so they see all of a publication or nothing of it, whatever step a crash hits; folders
that no list names are never read. The lists grow with the number of publications, not with rows; :func:`compact`
brings a table back to one folder. One writer at a time is assumed, as for the other stored tables.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from touchline import schemas
from touchline.operators import quality
from touchline.sources import tables

EVENTS, LEDGER = "events", "ledger"
LISTS = "_current"  # folder of the lists, numbered


def _files(spark: SparkSession, path: str):
    """The file system of ``path`` and the path as it takes it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, folder = _files(spark, f"{root}/{LISTS}")
    names = [status.getPath().getName() for status in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))


def folders(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """The folders of every published table, by the newest list."""
    numbers = _numbers(spark, root)
    if not numbers:
        return {}
    fs, path = _files(spark, f"{root}/{LISTS}/{numbers[-1]:08d}.json")
    stream = fs.open(path)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _list(spark: SparkSession, root: str, tables_now: Mapping[str, Sequence[str]]) -> None:
    """Make these folders current: the list is written aside and takes its number in one step."""
    number = max(_numbers(spark, root), default=0) + 1
    fs, aside = _files(spark, f"{root}/{LISTS}/{uuid.uuid4().hex}.tmp")
    out = fs.create(aside)
    out.write(bytearray(json.dumps(tables_now), "utf-8"))
    out.close()
    _, target = _files(spark, f"{root}/{LISTS}/{number:08d}.json")
    if fs.exists(target) or not fs.rename(aside, target):
        raise OSError(f"another writer published to {root}")


def publish(
    spark: SparkSession, root: str, add: Mapping[str, DataFrame] | None = None, replace: Mapping[str, DataFrame] | None = None,
    notes: Mapping[str, Sequence[str]] | None = None, checks: Mapping[str, Mapping[str, Column]] | None = None,
) -> None:
    """Add rows to some tables and replace others, all at once. ``notes`` are kept in the list next to the folders.

    The rows may be read from the tables themselves: nothing that is current is touched. ``checks`` name, by table, the
    conditions of a failing row; they are counted while the table is written, and if any row fails, none of the tables
    becomes current and a :class:`GateError` says which checks failed.
    """
    now = folders(spark, root)
    after = {**now, **(notes or {})}
    watched: dict[str, quality.Watch] = {}
    for kept, changes in ((True, add or {}), (False, replace or {})):
        for name, df in changes.items():
            load = f"load={uuid.uuid4().hex}"
            if checks and name in checks:
                watched[name] = quality.Watch(checks[name])
            watch = {"watch": watched[name].on} if name in watched else {}
            if name == EVENTS:
                tables.write_partitioned(df, f"{root}/{name}/{load}", **watch)
            else:
                (watched[name].on(df) if watch else df).write.parquet(f"{root}/{name}/{load}")
            after[name] = [*(now.get(name, []) if kept else []), load]
    quality.refuse("published", {f"{name}.{check}": n for name, seen in watched.items() for check, n in seen.failing().items()})
    _list(spark, root, after)


def read(spark: SparkSession, root: str, name: str, schema: T.StructType, only: Sequence[str] | None = None) -> DataFrame:
    """A published table, or some of its folders; a table that was never published is empty."""
    paths = folders(spark, root).get(name, []) if only is None else only
    if not paths:
        return spark.createDataFrame([], schema)
    base = f"{root}/{name}"
    rows = spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{path}" for path in paths])
    return rows.select(*schema.fieldNames())


def read_events(spark: SparkSession, root: str, only: Sequence[str] | None = None) -> DataFrame:
    return tables.with_provenance(read(spark, root, EVENTS, schemas.EVENT, only))


def compact(spark: SparkSession, root: str, name: str, schema: T.StructType) -> None:
    """The table in one folder. Views are built from it as a whole at their next refresh."""
    publish(spark, root, replace={name: read(spark, root, name, schema)})


def publish_events(spark: SparkSession, root: str, batch: DataFrame, outcomes: DataFrame) -> None:
    """Events that are not stored yet and the ledger rows of their matches, together.

    Stored keys are narrowed to the batch's matches first. A replay adds no event and gives the ledger the same rows.
    """
    near = batch.select("competition_id", "match_id").distinct()
    stored = read(spark, root, EVENTS, schemas.EVENT).select(*tables.EVENT_KEYS, "match_id")
    fresh = tables.new_rows(stored.join(near, ["competition_id", "match_id"], "left_semi"), batch)
    ledger = read(spark, root, LEDGER, schemas.LEDGER)
    publish(spark, root, add={EVENTS: fresh}, replace={LEDGER: tables.mark_ingested(ledger, outcomes)})


def refresh_partials(spark: SparkSession, root: str, view: str, build: Callable[[DataFrame], DataFrame], rebuild: bool = False) -> list[str]:
    """Bring the partial aggregates ``view`` up to the published events and return the folders that were read for it.

    ``build`` aggregates events to sums that may be added up across folders; an event is in one folder only, so the
    partials of a new folder are added and old ones stay. After a compaction, or with ``rebuild`` (new model values),
    they are built from all events.
    """
    now = folders(spark, root)
    have, covered = now.get(EVENTS, []), now.get(f"{view}/of", [])
    whole = rebuild or not set(covered) <= set(have)
    new = [load for load in have if whole or load not in set(covered)]
    if new:
        rows = build(read_events(spark, root, new))
        publish(spark, root, **{"replace" if whole else "add": {view: rows}}, notes={f"{view}/of": have})
    return new
