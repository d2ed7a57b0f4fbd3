"""A corpus pipeline out of the text operators: clean, deduplicate, decontaminate, redact, mix.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written and read again as the next one's
``docs``. The first four return the columns of documents; the last adds ``copies``, how often the mix takes a document,
and leaves out those it does not take. What a stage learns (classifier, random field, duplicates, source sizes) it learns
from the documents its predecessor kept; labels and benchmark items are read from ``sf_dir``.

In every stage: an empty table stays empty with the same columns; extra columns of any name are carried along untouched (only
the last stage replaces a ``copies`` that is there already); a null or empty text is clean, stands alone and holds nothing, so it
stays until the mix, which takes no copy of it; rows that repeat an id and a text are judged alike; rows without an id stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import decontamination, mixing, near_duplicates, pii, toxicity
from touchline.llm.common import materialise, table


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain rejects go; without labels none does."""
    return toxicity.remove_toxic(docs, table(spark, sf_dir, "labels"))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at a similarity of 0.8 or more stays, the one with the smallest id (all rows with it)."""
    return near_duplicates.keep_one(docs, 4, 5)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; an empty benchmark removes none."""
    return decontamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; every document stays, null texts stay null."""
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix with their number of copies; those it does not take, texts without words among them, go."""
    return mixing.mixed(docs)


STAGES = [
    ("toxicity", remove_toxic),
    ("near_duplicates", remove_near_duplicates),
    ("decontamination", remove_contaminated),
    ("pii", redact),
    ("mixing", mix),
]

# Classifiers, random fields and minwise trees have no SQL; the tests hold the stages to brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
