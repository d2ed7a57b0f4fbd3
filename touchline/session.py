"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

# Settings that can be changed on a running session.
# AQE splits skewed joins at run time, so a hot player or a hot match does not end in one task. Generated methods
# above 8000 bytes of bytecode are not compiled by HotSpot and run some six times slower than split ones.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Top-k per group keeps k rows per group and task before the shuffle up to this k (a page may hold 2000 rows).
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    # Keyed state with maps and timers, read and written entry by entry, needs this store.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}
# Settings for a session of our own.
DEFAULTS = {
    **RUNTIME,
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "touchline", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings a given session did not choose itself."""
    chosen = spark.sparkContext.getConf()
    for key, value in RUNTIME.items():
        if not chosen.contains(key):
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """This application's folder under ``spark.checkpoint.dir``; without that setting, under the warehouse.

    Both are folders every executor can reach. The application's folder goes when the driver's Python ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    application = spark.sparkContext.applicationId
    folder = f"{root.rstrip('/')}/touchline-{application}"
    if application not in _OWNED:
        _OWNED.add(application)
        atexit.register(release, spark, folder)
    return folder


_OWNED: set[str] = set()


def release(spark: SparkSession, folder: str | None = None) -> None:
    """Delete the application's folder with everything :func:`materialise` wrote. Results read from it are gone then."""
    with contextlib.suppress(Exception):  # the gateway may have ended before
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder or shared_folder(spark))
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back.

    Used where two branches of a plan must see the very same rows (range boundaries, model folds) and where
    an iterative fit would otherwise recompute its input. The table outlives a lost executor and is removed with the
    application's folder, because results are read from it lazily.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def run_together(spark: SparkSession, tasks: Sequence[Callable[[], T]], width: int = 4) -> list[T]:
    """Run independent fits at the same time, as the tuning classes of the ML library do; results in order."""
    with ThreadPoolExecutor(max_workers=max(1, min(width, len(tasks)))) as pool:
        return list(pool.map(lambda task: inheritable_thread_target(spark)(task)(), tasks))
