"""Shared helpers of the text operators: reading tables, words, fixed batches, bounded broadcasts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.session import materialise, tune

# Rows of an Arrow batch handed to Python. Whole documents can be long, so a batch stays small.
BATCH_ROWS = 1000
# Words are maximal runs of anything but these six characters (fixed by the data contract).
WORD = r"[^\x20\x09-\x0D]+"

__all__ = ["BATCH_ROWS", "WORD", "batches", "materialise", "parts_for", "prepare", "table", "unused", "word_count", "words"]


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the text operators rely on, where the session did not choose its own."""
    tune(spark)
    if not spark.sparkContext.getConf().contains("spark.sql.execution.arrow.maxRecordsPerBatch"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; ``bytes.split`` cuts at exactly the six ASCII white-space characters."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def word_count(text: Column) -> Column:
    """Number of words of a text column; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    """Arrow batches from tuples."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(held: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(col, type=field.type) for col, field in zip(zip(*held), schema)], schema=schema
    )


def parts_for(spark: SparkSession, amount: float, per_part: float) -> int:
    """Partitions so that each holds about ``per_part`` of ``amount``; at least the session's own number."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(np.ceil(amount / per_part)), 1)


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever the case of its letters."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name
