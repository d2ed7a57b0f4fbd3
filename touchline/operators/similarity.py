"""Nearest neighbours by cosine similarity: exact, and approximate with its recall.

Exact: vectors are grouped by their closest pivot (a cell) and cells are cut into blocks of a bounded number of rows.
Every vector first finds its best neighbours inside its own block. A cell can then be skipped when even its
closest possible member is worse than what the vector already has: on the unit sphere angles obey the triangle
inequality, so angle(vector, pivot) minus the cell's radius bounds every member from below. Blocks travel in strips of
16 MB. Vectors are sent, in chunks, only to the strips that hold a remaining cell, so a row travels once per strip at
most; a task multiplies its chunk with the remaining cells of the strip, a slice at a time, best cells first.
Data in clusters is pruned; vectors that point in all directions are not, whatever the bound, and every pair of
strips is multiplied. For those, and for very large tables, there is :func:`approximate_neighbours`.

Identical vectors are searched once: a group of copies is represented by one row that carries its smallest ids.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.numeric import round_any
from touchline.operators.metrics import scaler_statistics
from touchline.operators.running import top_per_group
from touchline.session import materialise

N_NEIGHBOURS = 10
BLOCK_ROWS = 16_384  # rows of a block: 8 MB at 64 dimensions
PIVOTS = 4096  # bound of the cells, whose pivots every task holds
SLICE_ROWS = 512  # rows of a product at a time
FIRST_COLUMNS, MOST_COLUMNS = 512, 8192  # columns of a product, at first and at most
STRIP_VALUES = 2_097_152  # components of a strip: 16 MB, 32,768 rows at 64 dimensions
CHUNK_ROWS = 1024  # queries that make a task worth its strip
NO_FLOOR = -2.0  # below any cosine
TABLES, BUCKET_ROWS = 12, 400  # approximate search: hash tables at first, rows a bucket aims at
EVERY, ASKED, RECALL = 50, 1024, 0.9  # ids that are audited, rows of a block of them, recall that is reached
SLACK = 2e-6  # two units of the last digit, so that rounding never hides a tie


def standardised(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """``key`` and ``vec``: columns scaled to zero mean and unit population deviation; nulls count as zero."""
    filled = df.select(key, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])
    filled = materialise(filled, "profiles")  # read twice: for the statistics and for the scaled rows
    stats = scaler_statistics(filled, cols).first()  # one row of means and deviations
    if stats[f"{cols[0]}_mean"] is None:
        return filled.select(key, F.array(*cols).alias("vec"))
    scaled = [(F.col(c) - F.lit(stats[f"{c}_mean"])) / F.lit(stats[f"{c}_std"]) for c in cols]
    return filled.select(key, F.array(*scaled).alias("vec"))


def unit(vec: Column) -> Column:
    """Vector of length one; a zero vector stays zero."""
    length = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x * x))
    return F.when(length > 0, F.transform(vec, lambda x: x / length)).otherwise(vec)


def _units6(values: np.ndarray) -> np.ndarray:
    """Cosines as whole millionths, rounded half away from zero after snapping to eight digits."""
    size = (np.floor(np.abs(values) * 1e8 + 0.5).astype("int64") + 50) // 100
    return np.where(values < 0, -size, size)


SELF = -(10**9)  # below any cosine


def _best(units: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row-wise top k columns by (cosine desc, id asc); ``ids`` is ascending.

    Cosine and position are packed into one number, so that a partial selection settles ties as well.
    """
    width = units.shape[1]
    k = min(k, width)
    packed = units * width - np.arange(width)
    top = np.argpartition(packed, width - k, axis=1)[:, width - k :]
    top = np.take_along_axis(top, np.argsort(-np.take_along_axis(packed, top, axis=1), axis=1), axis=1)
    return ids[top], np.take_along_axis(units, top, axis=1)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype("float64")


def _emit(query_ids: np.ndarray, ids: np.ndarray, units: np.ndarray) -> pd.DataFrame:
    width = ids.shape[1]
    out = pd.DataFrame({"id": np.repeat(query_ids, width), "other": ids.ravel(), "score": units.ravel() / 1e6})
    return out[units.ravel() != SELF]


_PAIRS = "id bigint, other bigint, score double"


def _distinct_vectors(points: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector: smallest id and the ``k + 1`` smallest ids."""
    first = top_per_group(points.withColumn("_h", F.xxhash64("vec")), ["_h", "vec"], [F.col("id").asc()], k + 1, "_r")
    members = F.array_sort(F.collect_list("id"))
    return first.groupBy("_h", "vec").agg(members.alias("members")).select(
        F.element_at("members", 1).alias("id"), "vec", "members"
    )


def _kept(rows: np.ndarray, units: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of candidates (row, units, id) the best ``k`` of every row by (units desc, id asc), by row."""
    order = np.lexsort((ids, -units, rows))
    rows, units, ids = rows[order], units[order], ids[order]
    best = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
    return rows[best], units[best], ids[best]


def _search(reps: DataFrame, k: int, block_rows: int, pivots: int) -> DataFrame:
    """Top ``k`` other representatives of every representative (non-zero unit vectors)."""
    c, spark = F.col, reps.sparkSession
    total, wide = reps.agg(F.count("*"), F.max(F.size("vec"))).first()  # one row
    if not total:
        return spark.createDataFrame([], _PAIRS)
    # A bounded sample of vectors, whatever the size of the table; a few cells per block of rows are enough.
    blocks_needed = math.ceil(total / block_rows)
    wanted = min(pivots, max(4 * (blocks_needed - 1), math.isqrt(total) if blocks_needed > 1 else 1, 1))
    sample = reps.orderBy(F.xxhash64("id"), "id").limit(wanted).collect()
    pivot = np.array([row["vec"] for row in sample], dtype="float64")

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), SLICE_ROWS):
                pdf = batch.iloc[at : at + SLICE_ROWS]
                dots = np.clip(_matrix(pdf["vec"]) @ pivot.T, -1, 1)
                cell = dots.argmax(axis=1)
                angle = np.arccos(dots[np.arange(len(pdf)), cell])
                yield pdf[["id", "vec"]].assign(cell=cell.astype("int32"), angle=angle)

    cells = materialise(
        reps.select("id", "vec").mapInPandas(assign, "id bigint, vec array<double>, cell int, angle double"), "cells"
    )
    # One row per pivot.
    stats = {r["cell"]: (r["n"], r["radius"]) for r in cells.groupBy("cell").agg(
        F.count("*").alias("n"), F.max("angle").alias("radius")).collect()}
    used = np.array(sorted(stats), dtype="int64")
    rows_of = np.array([stats[i][0] for i in used], dtype="float64")
    radius = np.array([stats[i][1] for i in used])
    blocks_of = np.ceil(rows_of / block_rows).astype("int64")
    first_block = np.cumsum(blocks_of) - blocks_of
    n_blocks = int(blocks_of.sum())
    # A strip is a run of blocks that goes to a task as a whole. Its size follows from the memory it takes and not from
    # the blocks, so that a row travels once per strip, however fine the blocks are.
    n_strips = min(n_blocks, math.ceil(total * max(wide, 1) / STRIP_VALUES))
    in_block = np.repeat(rows_of / blocks_of, blocks_of)
    strip_of = np.minimum((np.cumsum(in_block) - in_block / 2) * n_strips // total, n_strips - 1).astype("int32")
    # Cells with a block in the strip follow one another.
    low, high = strip_of[first_block], strip_of[first_block + blocks_of - 1]
    reach = [(int(np.searchsorted(high, s)), int(np.searchsorted(low, s, "right"))) for s in range(n_strips)]
    # The queries of a strip are dealt over some tasks where there are few strips.
    tasks = 2 * spark.sparkContext.defaultParallelism
    parts = max(1, min(math.ceil(tasks / n_strips**2), math.ceil(total / n_strips / CHUNK_ROWS)))

    layout = spark.createDataFrame(
        [(int(i), int(start), int(count)) for i, start, count in zip(used, first_block, blocks_of)], "cell int, start int, blocks int"
    )
    spread = F.xxhash64("id", F.lit(1))
    placed = cells.join(F.broadcast(layout), "cell").select(  # a row per pivot
        "id", "vec", "cell", (c("start") + F.pmod(spread, c("blocks"))).cast("int").alias("block")
    )

    def own(pdf: pd.DataFrame) -> pd.DataFrame:
        """The score that a better neighbour must reach: the k-th best inside the block, or none."""
        vecs, floors = _matrix(pdf["vec"]), np.full(len(pdf), NO_FLOOR)
        for at in range(0, len(pdf) if len(pdf) > k else 0, SLICE_ROWS):
            units = _units6(vecs[at : at + SLICE_ROWS] @ vecs.T)
            units[np.arange(len(units)), np.arange(at, at + len(units))] = SELF
            floors[at : at + SLICE_ROWS] = np.partition(units, units.shape[1] - k, axis=1)[:, units.shape[1] - k] / 1e6
        return pd.DataFrame({"id": pdf["id"], "vec": pdf["vec"], "cell": pdf["cell"], "strip": strip_of[pdf["block"]], "floor": floors})

    fields = "id bigint, vec array<double>, cell int, strip int, floor double"
    if n_blocks == 1:
        begun = placed.select("id", "vec", "cell", F.lit(0).alias("strip"), F.lit(NO_FLOOR).alias("floor"))
    else:
        begun = materialise(placed.groupBy("block").applyInPandas(lambda pdf: own(pdf), fields), "near")
    chunk = c("strip") * parts + F.pmod(F.xxhash64("id", F.lit(2)), F.lit(parts)).cast("int")
    begun = begun.withColumn("chunk", chunk)
    centre = pivot[used]

    def bounds(vecs: np.ndarray, at: slice | np.ndarray) -> np.ndarray:
        """The best cosine that a vector can have with a member of these cells."""
        angles = np.arccos(np.clip(vecs @ centre[at].T, -1, 1))
        return np.cos(np.maximum(angles - radius[at][None, :], 0.0)) + SLACK

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), SLICE_ROWS):
                pdf = batch.iloc[at : at + SLICE_ROWS]
                need = bounds(_matrix(pdf["vec"]), slice(None)) >= pdf["floor"].to_numpy()[:, None]
                asked = np.column_stack([need[:, a:b].any(axis=1) for a, b in reach])
                yield pdf.drop(columns="strip").assign(strips=[np.flatnonzero(row).astype("int32") for row in asked])

    routed = begun.mapInPandas(route, "id bigint, vec array<double>, cell int, floor double, chunk int, strips array<int>")
    asked = routed.withColumn("strip", F.explode("strips")).drop("strips")
    # A strip goes only to the chunks that ask for it.
    wanted_by = materialise(asked.select("strip", "chunk").distinct(), "wanted") if n_strips > 1 else begun.select("strip", "chunk").distinct()
    offered = begun.select("id", "vec", "cell", "strip").join(wanted_by, "strip")

    def across(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"id": [], "other": [], "score": []}).astype({"id": "int64", "other": "int64"})
        if not len(left) or not len(right):
            return none
        left, right = left.sort_values(["cell", "id"]), right.sort_values(["cell", "id"])
        ids, vecs, floors = left["id"].to_numpy(), _matrix(left["vec"]), left["floor"].to_numpy()
        there, others, place = right["id"].to_numpy(), _matrix(right["vec"]), np.searchsorted(used, right["cell"].to_numpy())
        here, first, size = np.unique(place, return_index=True, return_counts=True)
        found = [none]
        for at in range(0, len(ids), SLICE_ROWS):
            query, floor = vecs[at : at + SLICE_ROWS], floors[at : at + SLICE_ROWS].copy()
            bound = bounds(query, here)
            # The most promising cells first; what is found there rules out others.
            order = np.argsort(-bound.max(axis=0), kind="stable")
            columns = np.concatenate([np.arange(first[i], first[i] + size[i]) for i in order])
            cell = np.repeat(order, size[order])
            best = np.empty(0, "int64"), np.empty(0, "int64"), np.empty(0, "int64")
            step = FIRST_COLUMNS
            while True:
                left_over = (bound >= floor[:, None]).any(axis=0)[cell]
                columns, cell = columns[left_over], cell[left_over]
                if not len(columns):
                    break
                taken, columns, cell = columns[:step], columns[step:], cell[step:]
                dots = query @ others[taken].T
                row, col = np.nonzero(dots >= (floor - SLACK)[:, None])
                other = there[taken[col]]
                real = other != ids[at + row]
                row, other, units = row[real], other[real], _units6(dots[row[real], col[real]])
                best = _kept(*(np.concatenate(x) for x in zip(best, (row, units, other))), k)
                full = np.flatnonzero(np.bincount(best[0], minlength=len(floor)) == k)
                floor[full] = np.maximum(floor[full], best[1][np.searchsorted(best[0], full, "right") - 1] / 1e6)
                step = min(4 * step, MOST_COLUMNS)
            found.append(pd.DataFrame({"id": ids[at + best[0]], "other": best[2], "score": best[1] / 1e6}))
        return pd.concat(found, ignore_index=True)

    far = asked.groupBy("strip", "chunk").cogroup(offered.groupBy("strip", "chunk")).applyInPandas(across, _PAIRS)
    return top_per_group(far, ["id"], [c("score").desc(), c("other").asc()], k, "_r").drop("_r")


def cosine_neighbours(
    vectors: DataFrame, key: str, vec: str = "vec", n: int = N_NEIGHBOURS, block_rows: int = BLOCK_ROWS,
    pivots: int = PIVOTS, search: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The ``n`` most similar other rows of every row: ``key``, ``similar_<key>``, ``similarity_score``, ``rank``.

    Ordered by the cosine with six digits, then by id; a negative cosine is reported as zero. A zero vector has
    cosine zero with everything. ``search`` finds pairs of distinct vectors (given with the points), by default all.
    """
    c = F.col
    points = materialise(
        vectors.select(c(key).cast("bigint").alias("id"), unit(c(vec).cast("array<double>")).alias("vec")), "points"
    )
    is_zero = F.forall("vec", lambda x: x == 0)
    reps = materialise(_distinct_vectors(points.where(~is_zero), n), "vectors")
    pairs = search(reps, points) if search else _search(reps, n, block_rows, pivots)

    entry = F.struct((-c("score")).alias("neg"), c("other").alias("id"))
    others = (
        pairs.join(reps.select(c("id").alias("_rep"), "members"), c("other") == c("_rep"))
        .select("id", "score", F.explode("members").alias("other"))
        .groupBy("id").agg(F.collect_list(entry).alias("_others"))
    )
    # Copies of the row itself have cosine one; at most n + 1 of them and n * (n + 1) others per entry.
    lists = reps.join(others, "id", "left").select(
        c("vec").alias("_vec"), F.xxhash64("vec").alias("_h"),
        F.transform("members", lambda m: F.struct(F.lit(-1.0).alias("neg"), m.alias("id"))).alias("_copies"), "_others",
    )
    none = F.array().cast("array<struct<neg:double,id:bigint>>")
    # The few zero vectors that can matter: the smallest ids, at cosine zero.
    zeros = [r["id"] for r in points.where(is_zero).orderBy("id").limit(n + 1).collect()]
    lowest = [r["id"] for r in points.orderBy("id").limit(n + 1).collect()] if zeros else []

    def at_zero(ids: list[int]) -> Column:
        if not ids:
            return none
        return F.array(*[F.struct(F.lit(0.0).alias("neg"), F.lit(i).cast("bigint").alias("id")) for i in ids])

    keyed = points.withColumn("_h", F.xxhash64("vec"))
    # Every row of a group of copies meets one list; AQE splits the group if it is large.
    joined = keyed.join(lists, (keyed["_h"] == lists["_h"]) & (c("vec") == c("_vec")), "left")
    found = F.concat(F.coalesce("_copies", none), F.coalesce("_others", none), at_zero(zeros))
    found = F.when(is_zero, at_zero(lowest)).otherwise(found)
    own = F.filter(found, lambda e: e["id"] != c("id"))
    best = F.slice(F.array_sort(own), 1, n)
    ranked = joined.select(c("id").alias("_id"), F.posexplode(best).alias("_pos", "_e"))
    score = F.greatest(-c("_e.neg"), F.lit(0.0)) + F.lit(0.0)
    kind = vectors.schema[key].dataType
    return ranked.select(
        c("_id").cast(kind).alias(key), c("_e.id").cast(kind).alias(f"similar_{key}"),
        round_any(score, 6).alias("similarity_score"), (c("_pos") + 1).cast("int").alias("rank"),
    )


def _in_buckets(reps: DataFrame, total: int, k: int, tables: int, bucket_rows: int, seed: int) -> DataFrame:
    """Top ``k`` other rows among those that share a bucket of one of ``tables`` tables."""
    c = F.col
    wide = reps.select(F.max(F.size("vec"))).first()[0] or 1  # one row
    planes = max(1, math.ceil(math.log2(max(2, total / bucket_rows))))
    normal = np.random.default_rng(seed).normal(size=(tables * planes, wide))
    most = 8 * bucket_rows

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers = 1 << np.arange(planes, dtype="int64")
        for pdf in batches:
            if len(pdf):
                sides = (_matrix(pdf["vec"]) @ normal.T >= 0).reshape(len(pdf), tables, planes)
                yield pdf.assign(buckets=list((sides * powers).sum(axis=2) * tables + np.arange(tables)))

    hashed = reps.select("id", "vec").mapInPandas(sign, "id bigint, vec array<double>, buckets array<bigint>")
    spread = hashed.select("id", "vec", F.explode("buckets").alias("bucket"))
    # A large bucket is dealt in pairs of blocks, in which every two of its rows meet.
    rows = F.count("*")
    large = hashed.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(rows.alias("rows")).where(c("rows") > most)
    large = large.select("bucket", F.ceil(c("rows") / (most // 2)).cast("bigint").alias("parts"))  # at most one for ``most`` entries
    spread = spread.join(F.broadcast(large), "bucket", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("bigint")))
    spread = spread.withColumn("part", F.pmod(F.xxhash64("id"), c("parts")))
    spread = spread.withColumn("met", F.explode(F.sequence(F.lit(0).cast("bigint"), c("parts") - 1)))
    spread = spread.select("id", "vec", "bucket", F.least("part", "met").alias("low"), F.greatest("part", "met").alias("high"))

    def inside(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        ids, vecs = pdf["id"].to_numpy(), _matrix(pdf["vec"])
        parts = [pd.DataFrame({"id": ids[:0], "other": ids[:0], "score": np.empty(0)})]
        for at in range(0, len(ids) if len(ids) > 1 else 0, SLICE_ROWS):
            units = _units6(vecs[at : at + SLICE_ROWS] @ vecs.T)
            units[np.arange(len(units)), np.arange(at, at + len(units))] = SELF
            parts.append(_emit(ids[at : at + SLICE_ROWS], *_best(units, ids, k)))
        return pd.concat(parts, ignore_index=True)

    return spread.groupBy("bucket", "low", "high").applyInPandas(lambda pdf: inside(pdf[["id", "vec"]]), _PAIRS)


def _brute(reps: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The exact top ``k`` other rows of the rows of ``asked``, a block of ``ASKED`` of them at a time."""
    parts = max(1, math.ceil(asked.count() / ASKED))
    found = reps.sparkSession.createDataFrame([], _PAIRS)
    for part in range(parts):
        block = asked.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(parts)) == part).select("id", "vec").collect()  # bounded
        if not block:
            continue
        ids, query = np.array([r["id"] for r in block], dtype="int64"), np.array([r["vec"] for r in block], dtype="float64")

        def all_of(batches: Iterator[pd.DataFrame], ids=ids, query=query) -> Iterator[pd.DataFrame]:
            best: tuple[np.ndarray, np.ndarray] | None = None
            for pdf in batches:
                if not len(pdf):
                    continue
                pdf = pdf.sort_values("id")
                there = pdf["id"].to_numpy()
                units = _units6(query @ _matrix(pdf["vec"]).T)
                units[ids[:, None] == there[None, :]] = SELF
                more = _best(units, there, k)
                other, score = more if best is None else (np.hstack(x) for x in zip(best, more))
                order = np.lexsort((other, -score))[:, :k]
                best = np.take_along_axis(other, order, 1), np.take_along_axis(score, order, 1)
            if best is not None:
                yield _emit(ids, *best)

        found = found.unionByName(materialise(reps.select("id", "vec").mapInPandas(all_of, _PAIRS), "asked"))
    return _top(found, k)


def _top(pairs: DataFrame, k: int) -> DataFrame:
    return top_per_group(pairs.distinct(), ["id"], [F.col("score").desc(), F.col("other").asc()], k, "_r").drop("_r")


def tables_for(least: float, reached: float, tables: int) -> float:
    """Tables that reach a recall of ``least`` if ``tables`` of them reach ``reached``, each by itself as likely as another."""
    if reached <= 0 or reached >= 1:
        return math.inf if reached <= 0 else tables
    return tables * math.log(max(1 - least, 1e-9)) / math.log(1 - reached)


def approximate_neighbours(
    vectors: DataFrame, key: str, vec: str = "vec", n: int = N_NEIGHBOURS, tables: int = TABLES,
    bucket_rows: int = BUCKET_ROWS, seed: int = 11, least: float = RECALL,
) -> DataFrame:
    """Columns of :func:`cosine_neighbours` and ``recall``: most similar rows among those that share a bucket, by exact cosine.

    Random hyperplanes cut the space; a vector's bucket in each of ``tables`` tables is the sides it lies on, with as many
    planes as make buckets of about ``bucket_rows`` vectors. A bucket above eight times that is compared in pairs of blocks,
    and vectors that met fewer than ``n`` others are compared with all. ``recall`` compares the answers of all ids divisible
    by ``EVERY`` with brute force, so that this part grows with the square. Below ``least`` the tables are doubled, as long
    as the recall so far lets them reach it with fewer copies of the table than the exact search sends, and with buckets
    that hold fewer rows than the table; otherwise every pair of strips is compared instead.
    """
    reached = 1.0

    def search(reps: DataFrame, points: DataFrame) -> DataFrame:
        nonlocal reached
        total, done, more = reps.count(), 0, tables
        wanted = min(n, total - 1)
        if wanted < 1:
            return _search(reps, n, BLOCK_ROWS, PIVOTS)
        audit = points.where(F.col("id") % EVERY == 0).select(F.xxhash64("vec").alias("_h"), "vec").distinct()
        audit = materialise(reps.select(F.xxhash64("vec").alias("_h"), "id", "vec").join(audit, ["_h", "vec"], "left_semi"), "audit")
        exact = materialise(_brute(reps, audit, n), "exact")
        best = reps.sparkSession.createDataFrame([], _PAIRS)
        # A table sends every vector once, the exact search as a query and as a candidate once per strip.
        wide = reps.select(F.max(F.size("vec"))).first()[0] or 1  # one row
        most = max(tables, 2 * math.ceil(total * wide / STRIP_VALUES))
        while not done or (8 * bucket_rows * (done + more) < total and tables_for(least, reached, done) <= most):
            best = materialise(_top(best.unionByName(_in_buckets(reps, total, n, more, bucket_rows, seed + done)), n), "approximate")
            done += more
            more = done
            hit = exact.join(best.select("id", "other", F.lit(1).alias("_hit")), ["id", "other"], "left")
            reached = hit.agg(F.avg(F.coalesce("_hit", F.lit(0)))).first()[0]  # one row
            reached = 0.0 if reached is None else reached
            if reached >= least:
                met = best.groupBy("id").agg(F.count("*").alias("met")).where(F.col("met") >= wanted)
                short = materialise(reps.select("id", "vec").join(met, "id", "left_anti"), "short")
                if short.count() * 8 <= total:
                    return _top(best.unionByName(_brute(reps, short, n)), n)
        reached = 1.0
        return _search(reps, n, BLOCK_ROWS, PIVOTS)

    return cosine_neighbours(vectors, key, vec, n, search=search).withColumn("recall", F.lit(float(reached)))


def neighbour_rank(scores: DataFrame, key: str, other: str, score: str, n: int = N_NEIGHBOURS) -> DataFrame:
    """Rank already scored pairs per key, best first, and keep the first ``n``."""
    return top_per_group(scores, [key], [F.col(score).desc(), F.col(other).asc()], n, "rank")


def player_similarity(
    features: DataFrame, cols: Sequence[str], n: int = N_NEIGHBOURS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Similarity table over player profiles. It replaces the stored table as a whole, so no stale pair stays."""
    return cosine_neighbours(standardised(features, "player_id", cols), "player_id", n=n, block_rows=block_rows)


def top_neighbours(scores: DataFrame, player_id: int, n: int = N_NEIGHBOURS) -> DataFrame:
    n = max(1, min(n, N_NEIGHBOURS))
    return scores.where((F.col("player_id") == player_id) & (F.col("rank") <= n)).orderBy("rank")
