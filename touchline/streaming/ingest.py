"""Match files as they arrive: canonical events, stored once, recorded in the ledger."""

from __future__ import annotations

import logging
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from touchline import schemas
from touchline.session import shared_folder
from touchline.sources import feeds, published, tables

log = logging.getLogger(__name__)


Store = Callable[[DataFrame, DataFrame], None]  # what is done with the events and the ledger rows of a batch


def store_batch(docs: DataFrame, provider: str, competition_id: int, events_path: str, ledger_path: str) -> None:
    """Store one micro-batch of files: first its events, then its ledger rows (:func:`map_batch`)."""
    spark = docs.sparkSession

    def store(good: DataFrame, outcomes: DataFrame) -> None:
        tables.append_events(spark, good, events_path)
        if tables.table_exists(spark, ledger_path):
            ledger = tables.read_table(spark, ledger_path, schemas.LEDGER)
        else:
            ledger = spark.createDataFrame([], schemas.LEDGER)
        tables.replace_table(tables.mark_ingested(ledger, outcomes), ledger_path)

    map_batch(docs, provider, competition_id, store)


def publish_batch(docs: DataFrame, provider: str, competition_id: int, root: str) -> None:
    """Store one micro-batch of files, events and ledger rows in one publication (:mod:`touchline.sources.published`)."""
    map_batch(docs, provider, competition_id, lambda good, outcomes: published.publish_events(docs.sparkSession, root, good, outcomes))


def map_batch(docs: DataFrame, provider: str, competition_id: int, store: Store) -> None:
    """Map one micro-batch of files (:func:`feeds.documents`) and hand its events and the ledger rows of its matches to ``store``.

    A match all of whose files load is a ``success`` with its number of events. A broken file, or an event without a
    whole key, makes it an ``error`` with count 0, to be retried: nothing of it is stored. A file without a match id has
    no row in the ledger; it is logged. A replay after a failure adds nothing, because known ids are left out.
    """
    docs = docs.persist()
    try:
        nameless = docs.where(F.col("match_id").isNull())
        if not nameless.isEmpty():
            log.warning("files without a match id: %s", [r["file"] for r in nameless.select("file").limit(10).collect()])
        named = docs.where(F.col("match_id").isNotNull())
        events = feeds.map_documents(named, provider, competition_id).persist()
        keyless = reduce(lambda a, b: a | b, [F.col(key).isNull() for key in tables.EVENT_KEYS])
        counts = events.groupBy("match_id").agg(F.count("*").alias("_n"), F.count_if(keyless).alias("_keyless"))
        state = named.groupBy("match_id").agg(F.count("error").alias("_errors")).join(counts, "match_id", "left")
        failed = (F.col("_errors") > 0) | (F.coalesce("_keyless", F.lit(0)) > 0)
        state = state.select("match_id", failed.alias("_failed"), F.coalesce("_n", F.lit(0)).cast("bigint").alias("_n"))
        good = events.join(state.where(~F.col("_failed")).select("match_id"), "match_id", "left_semi")
        outcomes = state.select(
            "match_id", F.lit(competition_id).alias("competition_id"),
            F.when(F.col("_failed"), F.lit(0).cast("bigint")).otherwise(F.col("_n")).alias("event_count"),
            F.when(F.col("_failed"), "error").otherwise("success").alias("status"),
            F.current_timestamp().alias("ingested_at"),
        ).select(*schemas.LEDGER.fieldNames())
        store(good.select(*events.columns), outcomes)
        events.unpersist()
    finally:
        docs.unpersist()


def retry_failed(
    spark: SparkSession, provider: str, feed_path: str, events_path: str, ledger_path: str, competition_id: int = 0,
    files_per_batch: int = 1000,
) -> int:
    """Read the files of every match that the ledger does not call a success again, and how many files that were.

    Progress of a stream goes by file names, so a file that is mended in place would never be offered again; the ledger
    knows the match. Only the failed matches' files are read, in batches like those of the stream. What is still broken
    stays an ``error``.
    """
    if not tables.table_exists(spark, ledger_path):
        return 0
    ledger = tables.read_table(spark, ledger_path, schemas.LEDGER)
    return _read_again(
        provider, feed_path, ledger, lambda docs: store_batch(docs, provider, competition_id, events_path, ledger_path), files_per_batch
    )


def _read_again(provider: str, feed_path: str, ledger: DataFrame, store: Callable[[DataFrame], None], files_per_batch: int = 1000) -> int:
    spark = ledger.sparkSession
    failed = ledger.where(F.col("status") != "success")
    if failed.isEmpty():
        return 0
    paths = feeds.files_of(spark, feed_path, failed)
    for k in range(0, len(paths), files_per_batch):
        docs = feeds.documents(spark.read.option("wholetext", True).text(paths[k : k + files_per_batch]), provider)
        store(docs)
    return len(paths)


def stream_ingest(
    spark: SparkSession, provider: str, feed_path: str, events_path: str, ledger_path: str, checkpoint: str,
    competition_id: int = 0,
) -> StreamingQuery:
    """Load every file not loaded before, and the files of failed matches again, then stop. Progress is kept in
    ``checkpoint``. A match that failed in an earlier run is read again under the name it has, mended or not."""
    retry_failed(spark, provider, feed_path, events_path, ledger_path, competition_id)
    docs = feeds.stream_documents(spark, provider, feed_path)
    return (
        docs.writeStream.foreachBatch(lambda batch, _: store_batch(batch, provider, competition_id, events_path, ledger_path))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def stream_publish(
    spark: SparkSession, provider: str, feed_path: str, root: str, checkpoint: str, competition_id: int = 0
) -> StreamingQuery:
    """:func:`stream_ingest` into published tables: no reader ever sees events without their ledger rows or the reverse."""
    ledger = published.read(spark, root, published.LEDGER, schemas.LEDGER)
    _read_again(provider, feed_path, ledger, lambda docs: publish_batch(docs, provider, competition_id, root))
    return (
        feeds.stream_documents(spark, provider, feed_path)
        .writeStream.foreachBatch(lambda batch, _: publish_batch(batch, provider, competition_id, root))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def stream_dedup(
    events: DataFrame, event_time: str, delay: str = "10 minutes", keys: tuple[str, ...] = tables.EVENT_KEYS
) -> DataFrame:
    """Drop repeats of a key that arrive within the delay; the state forgets a key after it."""
    return events.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def run_to_table(stream: DataFrame, tag: str) -> DataFrame:
    """Run a stream over what is available and read back what it wrote to the shared folder."""
    import uuid

    spark = stream.sparkSession
    base = f"{shared_folder(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    query = (
        stream.writeStream.format("parquet").option("path", f"{base}/rows")
        .option("checkpointLocation", f"{base}/progress").outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/rows")
