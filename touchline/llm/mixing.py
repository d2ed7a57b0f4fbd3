"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words. Its documents get the whole copies that fit the target, which are certain;
the fraction that is left is drawn without replacement. A document's rank in the draw is the odds of a uniform number
divided by the odds of its inclusion probability (Rosen's order sampling with a Pareto distribution), and the lowest
ranks are taken until the words that are missing are reached, so a source ends within half a document of its target.
The uniform number comes from a hash of the document's id, so reruns and retried tasks draw the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import materialise, prepare, unused, word_count

WEIGHTS = (5, 2, 1)  # by position of the source, repeating
CAP = 3  # no source and no document gives more than this many times its size
HALF = 100  # words at which a document's preference is one half
BINS = 4096  # histogram of ranks, in which the end of the draw is found
SEED = "mix"


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, share: float = 1.0) -> DataFrame:
    """``source, source_size, target`` from ``source, size``: weighted shares of all words, capped and reshared.

    Resharing what the cap cuts off until nothing is above it has a closed form: in order of size over weight, the
    sources below some point are capped and the rest share what is left by weight. The tables here have a row a source.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = Window.orderBy(F.col("source").asc_nulls_last())
    at = (F.row_number().over(place) - 1) % len(weights)
    ranked = by_source.select("source", "source_size", F.element_at(F.array(*map(F.lit, weights)), at + 1).alias("w"))
    order = [F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last()]
    up = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    down = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    big = "decimal(38,0)"
    words = F.sum(F.col("source_size").cast(big)).over(every)
    total = words if share == 1.0 else F.floor(words * F.lit(share))
    level = ranked.select(
        "source", "source_size", "w", (F.col("source_size") * cap).alias("most"),
        (total - F.coalesce(F.sum(F.col("source_size").cast(big) * cap).over(up), F.lit(0))).cast(big).alias("rest"),
        F.sum("w").over(down).alias("shares"),
    )
    fits = F.col("rest") * F.col("w") <= F.col("most").cast(big) * F.col("shares")
    first = F.min(F.when(fits, F.struct(F.col("source_size") / F.col("w"), "source_size", "rest", "shares"))).over(every)
    level = level.withColumn("first", first)
    open_share = (F.col("first.rest") * F.col("w")).cast("double") / F.col("first.shares").cast("double")
    target = F.when(F.col("first").isNull(), F.col("most").cast("double")).otherwise(
        F.least(open_share, F.col("most").cast("double"))
    )
    return level.select("source", "source_size", target.alias("target"))


def uniform(doc_id: Column, seed: str = SEED) -> Column:
    """A number between 0 and 1 from the id, the same in every engine that has md5."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, share: float = 1.0, seed: str = SEED
) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken``: one row per input row.

    Null and empty texts have size 0 and are never copied; a null source is a source of its own, the last one. Rows
    with equal ranks (the same id twice) are taken in order of size. An empty table gives no rows. Other columns of
    ``docs`` are not looked at.
    """
    spark = prepare(docs.sparkSession)
    sizes = materialise(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    targets = materialise(source_targets(sizes, weights, cap, share), "mix-targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.least(F.floor(ratio), F.lit(cap).cast("long"))
    targets = targets.select(
        F.col("source").alias("of"), "source_size", "target", whole.alias("whole"),
        (F.col("target") - whole * F.col("source_size")).alias("need"), (ratio - whole).alias("part"),
    )
    rows = sizes.join(targets, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    u, p = uniform(F.col("doc_id"), seed), F.col("part") * (F.col("size") / (F.col("size") + float(HALF)))
    rank = F.when((F.col("size") > 0) & (p > 0), (u / (1 - u)) / (p / (1 - p)))
    rows = rows.withColumn("rank", rank).withColumn("bin", F.floor(F.col("rank") / (1 + F.col("rank")) * BINS))
    # Where the draw ends: sums per source and bin first, then one bin of each source in order.
    drawn = rows.filter(F.col("rank").isNotNull())
    bins = drawn.groupBy("source", "bin").agg(F.sum("size").alias("in_bin"), F.first("need").alias("need"))
    before = F.sum("in_bin").over(Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
    bins = bins.withColumn("before", F.coalesce(before, F.lit(0)))
    last = bins.filter((F.col("before") <= F.col("need")) & (F.col("before") + F.col("in_bin") > F.col("need")))
    last = materialise(last.select(F.col("source").alias("of"), F.col("bin").alias("last_bin"), "before"), "mix-last")
    rows = rows.join(last, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    edge = F.col("bin") == F.col("last_bin")
    inside = rows.filter(edge)
    ahead = Window.partitionBy("source").orderBy("rank", F.col("doc_id").asc_nulls_last(), "size")
    done = F.col("before") + F.coalesce(F.sum("size").over(ahead.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = inside.withColumn("drawn", (2 * done + F.col("size") <= 2 * F.col("need")).cast("long"))
    # Without an edge the whole source fits into what is missing.
    fits = F.col("rank").isNotNull() & (F.col("last_bin").isNull() | (F.col("bin") < F.col("last_bin")))
    outside = rows.filter(~F.coalesce(edge, F.lit(False))).withColumn("drawn", fits.cast("long"))
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("drawn")).otherwise(F.lit(0)).cast("long")
    return outside.unionByName(inside).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with a last column ``copies``; rows that repeat an id and a size go alike.

    Other columns of any name stay as they are, but for a ``copies`` that is there already: the mix's takes its place.
    """
    taken = mix(docs, **options).filter("copies > 0").groupBy("doc_id", "source", "size").agg(F.max("copies").alias("copies"))
    rows = docs.drop("copies")
    words = unused(rows, "words")
    keys = [unused(rows, f"{words}_{k}") for k in ("id", "source", "size")]
    rows, taken = rows.withColumn(words, word_count(F.col("text"))), taken.toDF(*keys, "copies")
    same = rows["doc_id"].eqNullSafe(taken[keys[0]]) & rows["source"].eqNullSafe(taken[keys[1]]) & (rows[words] == taken[keys[2]])
    return rows.join(taken, same).drop(words, *keys)


MIX_SQL = rf"""
WITH sizes AS (
  SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
by_source AS (SELECT source, SUM(size)::HUGEINT AS source_size FROM sizes GROUP BY source),
ranked AS (
  SELECT *, CAST([5, 2, 1][((ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1] AS HUGEINT) AS w FROM by_source),
level AS (
  SELECT *, source_size * {CAP} AS most, source_size::DOUBLE / w::DOUBLE AS pos,
    (SELECT SUM(source_size) FROM by_source)::HUGEINT - COALESCE(SUM(source_size * {CAP}) OVER before, 0)::HUGEINT AS rest,
    (SUM(w) OVER after)::HUGEINT AS shares
  FROM ranked
  WINDOW before AS (ORDER BY source_size::DOUBLE / w::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    after AS (ORDER BY source_size::DOUBLE / w::DOUBLE, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
first_open AS (
  SELECT rest, shares FROM level WHERE rest * w <= most * shares ORDER BY pos, source_size, rest LIMIT 1),
targets AS (
  SELECT source, source_size, LEAST((f.rest * w)::DOUBLE / f.shares::DOUBLE, most::DOUBLE) AS target FROM level, first_open f
  ),
shaped AS (
  SELECT *, CASE WHEN source_size > 0 THEN LEAST(FLOOR(target / source_size::DOUBLE), {CAP}) ELSE 0 END AS whole,
    CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0 END AS ratio FROM targets),
rows AS (
  SELECT s.doc_id, s.source, s.size, t.source_size, t.target, t.whole, t.target - t.whole * t.source_size::DOUBLE AS need,
    (t.ratio - t.whole) * (s.size::DOUBLE / (s.size::DOUBLE + {HALF}.0::DOUBLE)) AS p,
    ((('0x' || substr(md5(COALESCE(CAST(s.doc_id AS VARCHAR), '') || ':{SEED}'), 1, 13))::BIGINT)::DOUBLE + 0.5::DOUBLE)
      / {1 << 52}::DOUBLE AS u
  FROM sizes s JOIN shaped t ON s.source IS NOT DISTINCT FROM t.source),
ranks AS (SELECT *, CASE WHEN size > 0 AND p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS rank FROM rows),
drawn AS (
  SELECT *, COALESCE(SUM(size) OVER (PARTITION BY source, rank IS NULL ORDER BY rank, doc_id NULLS LAST, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done FROM ranks)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
  CASE WHEN size > 0 THEN (whole + CASE WHEN rank IS NOT NULL AND 2 * done + size <= 2 * need THEN 1 ELSE 0 END)::BIGINT * size
    ELSE 0 END AS taken
FROM drawn
"""
