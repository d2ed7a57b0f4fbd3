"""Embedding near-duplicates on a robust-pruned flat graph.

1. Centroids of a bounded sample of vectors cut the space into cells; every vector goes to its ``overlap`` nearest cells,
   so that near vectors meet in one even at a border. A cell above ``CAP`` vectors is dealt in pairs of blocks, in which
   every two of its vectors meet once; no task ever holds more than ``CAP`` vectors.
2. In each shard a vector's nearest and a few far candidates are pruned robustly: a candidate stays unless one that was
   kept is much nearer to it than the vector itself. The adjacency lists of all shards of a vector are united.
3. Every vector is searched for in each of its shards: a greedy beam walks from the shard's medoid, then the search
   widens from what lies within range (and from the vector's own node, since all queries are indexed) through all
   neighbours in range until none is new. Each cosine is taken in double precision, so what is found is verified.
4. A pair that meets in several shards counts in one of them only, which the cells of the two name; tasks return a
   number of links per vector and a spanning forest, never all pairs.
5. Recall is measured against brute force for the stated queries (all ids divisible by ``EVERY``, in blocks of ``AUDIT``),
   averaged over the queries with links, and over those of them outside large groups (at most ``per_cell`` links), so that
   a large group does not speak for the small ones. If no stated query has a link, ``AUDIT`` of the vectors that the search
   linked are measured instead; if it linked none, the recall is unknown and null. While either is below ``RECALL``, the overlap is doubled and the search
   repeated; when that would cost more than comparing all pairs of blocks, they are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import materialise, prepare
from touchline.llm.components import components

LINK = 0.9  # cosine of a link
PER_CELL, MOST_CELLS, SAMPLE = 500, 4096, 32_768  # vectors a cell aims at; bounds of centroids and of their sample
OVERLAP = 3  # cells of a vector
CAP = 2048  # vectors of a shard
DEGREE, POOL, FAR, ALPHA = 24, 48, 8, 1.2  # edges kept, nearest and far candidates, pruning slack
BEAM = 24
EVERY, AUDIT, RECALL = 50, 1024, 0.95

Packed = "vec_id long, vector binary"


def _valid(vectors: DataFrame) -> DataFrame:
    """``vec_id, vector`` (packed doubles of length one): one row per id that has a usable vector."""

    def pack(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks:
            ids, packed = [], []
            for vec_id, values in zip(chunk.column(0).to_pylist(), chunk.column(1).to_pylist()):
                if vec_id is None or not values or None in values:
                    continue
                x = np.array(values, dtype=np.float64)
                with np.errstate(all="ignore"):
                    scaled = x / np.abs(x).max() if np.isfinite(x).all() and np.abs(x).max() > 0 else None
                if scaled is not None:
                    ids.append(vec_id)
                    packed.append((scaled / np.sqrt((scaled * scaled).sum())).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(packed, pa.binary())], names=["vec_id", "vector"])

    rows = vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(pack, Packed)
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def lengths(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Numbers of components of packed vectors."""
    return np.array([x.as_buffer().size // 8 for x in column], dtype=np.int64)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of packed vectors, shorter ones filled with zeros; whether two rows are comparable is for :func:`lengths` to say."""
    rows = [np.frombuffer(x.as_buffer(), dtype=np.float64) for x in column]
    wide = max(map(len, rows), default=0)
    if all(len(r) == wide for r in rows):
        return np.array(rows).reshape(len(rows), wide)
    return np.array([np.pad(r, (0, wide - len(r))) for r in rows])


def centroids(vectors: DataFrame, n: int, per_cell: int = PER_CELL) -> np.ndarray:
    """Unit centroids by a few rounds of spherical k-means on at most ``SAMPLE`` vectors, chosen by a hash of the id."""
    k = max(1, min(MOST_CELLS, -(-n // per_cell)))
    picked = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(min(SAMPLE, 16 * k)).toArrow()
    sample = matrix(picked.column("vector"))
    if not len(sample):
        return np.zeros((1, 1))
    middle = sample[:k].copy()
    for _ in range(6):
        own = (sample @ middle.T).argmax(1)
        sums = np.zeros_like(middle)
        np.add.at(sums, own, sample)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        middle = np.where(size > 1e-12, sums / np.maximum(size, 1e-12), middle)
    return middle


def _assigned(vectors: DataFrame, middle: np.ndarray, overlap: int) -> DataFrame:
    """``vec_id, vector, cells``: the nearest cells, in ascending order."""
    shared = vectors.sparkSession.sparkContext.broadcast(middle)  # at most MOST_CELLS rows

    def assign(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        most = min(overlap, len(c))
        for chunk in chunks:
            x = matrix(chunk.column(1))
            wide = min(x.shape[1], c.shape[1])
            near = x[:, :wide] @ c[:, :wide].T
            cells = np.sort(np.argpartition(-near, most - 1, axis=1)[:, :most], axis=1)
            column = pa.FixedSizeListArray.from_arrays(pa.array(cells.ravel(), pa.int32()), most).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([chunk.column(0), chunk.column(1), column], names=["vec_id", "vector", "cells"])

    return vectors.mapInArrow(assign, f"{Packed}, cells array<int>")


def _shards(assigned: DataFrame, cap: int) -> DataFrame:
    """A row per vector and shard: ``shard, cell, block, low, high`` are added."""
    rows = assigned.select("*", F.explode("cells").alias("cell"))
    sizes = rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / (cap // 2)).cast("long").alias("halves"), F.count(F.lit(1)).alias("n"))
    blocks = F.when(F.col("n") <= cap, F.lit(1).cast("long")).otherwise(F.col("halves"))
    rows = rows.join(sizes.select("cell", blocks.alias("blocks")), "cell")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    return rows.select(F.xxhash64("cell", low, high).alias("shard"), "cell", "block", low.alias("low"), high.alias("high"), "vec_id", "vector", "cells")


def robust_graph(x: np.ndarray, seed: int = 7) -> list[np.ndarray]:
    """Neighbours of every row after robust pruning of its nearest and some far candidates."""
    n = len(x)
    if n < 2:
        return [np.empty(0, np.int64)] * n
    k = min(POOL, n - 1)
    rng = np.random.default_rng(seed)
    out: list[np.ndarray] = []
    for a in range(0, n, 256):
        rows = np.arange(a, min(a + 256, n))
        near = x[rows] @ x.T
        near[np.arange(len(rows)), rows] = -2.0
        pool = np.argpartition(-near, k - 1, axis=1)[:, :k]
        pool = np.concatenate([pool, rng.integers(0, n, (len(rows), FAR))], axis=1)
        cos = np.take_along_axis(near, pool, 1)
        order = np.argsort(-cos, axis=1, kind="stable")
        pool, cos = np.take_along_axis(pool, order, 1), np.take_along_axis(cos, order, 1)
        away = np.sqrt(np.maximum(0.0, 2 - 2 * cos))
        between = np.einsum("ijd,ikd->ijk", x[pool], x[pool], optimize=True)
        between = np.sqrt(np.maximum(0.0, 2 - 2 * between))
        open_ = (cos > -2.0) & (pool != rows[:, None])
        kept, count = np.zeros_like(open_), np.zeros(len(rows), np.int64)
        for j in range(pool.shape[1]):
            take = open_[:, j] & (count < DEGREE)
            kept[:, j] = take
            count += take
            open_[:, j] = False
            open_ &= ~(take[:, None] & (ALPHA * between[:, j, :] <= away))
        out += [np.unique(p[m]) for p, m in zip(pool, kept)]
    return out


class Graph:
    """Undirected adjacency of a shard in flat arrays."""

    def __init__(self, neighbours: list[np.ndarray]):
        n = len(neighbours)
        a = np.repeat(np.arange(n), [len(x) for x in neighbours])
        b = np.concatenate([*neighbours, np.empty(0, np.int64)]).astype(np.int64)
        both = np.unique(np.concatenate([a * n + b, b * n + a]))
        a, self.to = both // max(n, 1), both % max(n, 1)
        self.start = np.searchsorted(a, np.arange(n + 1))

    def steps(self, query: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, neighbour) for all neighbours of the nodes."""
        count = self.start[node + 1] - self.start[node]
        ahead = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return np.repeat(query, count), self.to[np.repeat(self.start[node], count) + ahead]


def range_search(x: np.ndarray, graph: Graph, least: float, beam: int = BEAM, size: np.ndarray | None = None) -> np.ndarray:
    """Which rows are found within range of which: beams from the medoid, then widening through what is in range.

    Rows of unlike ``size`` are never in range of each other.
    """
    n = len(x)
    seen, found = np.zeros((n, n), bool), np.zeros((n, n), bool)
    if n < 2:
        return found
    size = np.zeros(n, np.int64) if size is None else size

    def look(query: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        new = ~seen[query, node]
        pair = np.unique(query[new] * n + node[new])
        query, node = pair // n, pair % n
        seen[query, node] = True
        cos = np.concatenate([np.einsum("ij,ij->i", x[query[i : i + 65536]], x[node[i : i + 65536]]) for i in range(0, len(query), 65536)] or [np.empty(0)])
        cos = np.where(size[query] == size[node], cos, np.minimum(cos, np.nextafter(least, -2)))
        inside = cos >= least
        found[query[inside], node[inside]] = True
        return query, node, cos

    every = np.arange(n)
    medoid = int((x @ x.sum(0)).argmax())
    best_cos, best = np.full((n, beam), -2.0), np.full((n, beam), -1)
    done = np.ones((n, beam), bool)
    best_cos[:, 0], best[:, 0], done[:, 0] = x @ x[medoid], medoid, False
    seen[every, medoid] = True
    found[:, medoid] = (best_cos[:, 0] >= least) & (size == size[medoid])
    for _ in range(4 * beam):
        at = np.where(done, -3.0, best_cos).argmax(1)
        active = np.flatnonzero(~done[every, at])
        if not len(active):
            break
        done[active, at[active]] = True
        query, node, cos = look(*graph.steps(active, best[active, at[active]]))
        if not len(query):
            continue
        first = np.searchsorted(query, every)
        width = int((np.searchsorted(query, every, "right") - first).max())
        slot = np.arange(len(query)) - first[query]
        more_cos, more = np.full((n, width), -2.0), np.full((n, width), -1)
        more_cos[query, slot], more[query, slot] = cos, node
        all_cos, all_, all_done = np.hstack([best_cos, more_cos]), np.hstack([best, more]), np.hstack([done, more_cos <= -2.0])
        top = np.argpartition(-all_cos, beam - 1, axis=1)[:, :beam]
        best_cos, best, done = (np.take_along_axis(z, top, 1) for z in (all_cos, all_, all_done))
    seen[every, every] = True
    found[every, every] = False
    query, node = np.nonzero(found)
    query, node = np.concatenate([every, query]), np.concatenate([every, node])
    while len(query):
        new_query, new_node = [], []
        for i in range(0, len(query), 65536):
            q, v, cos = look(*graph.steps(query[i : i + 65536], node[i : i + 65536]))
            new_query.append(q[cos >= least])
            new_node.append(v[cos >= least])
        query, node = np.concatenate(new_query), np.concatenate(new_node)
    return found | found.T


def _links_of(group: pa.Table, least: float) -> pa.Table:
    """Links per vector that count in this shard, and a spanning forest of all that were found.

    With lists of neighbours (``near``) they are searched along the graph, without by comparing all rows.
    """
    group = group.sort_by("vec_id")
    ids, block = group.column("vec_id").to_numpy(), group.column("block").to_numpy()
    cell, low, high = (group.column(c)[0].as_py() for c in ("cell", "low", "high"))
    x, size = matrix(group.column("vector")), lengths(group.column("vector"))
    cells = np.array(group.column("cells").to_pylist())
    if "near" in group.column_names:
        lists = []
        for near in group.column("near").to_pylist():
            near = np.array(near or [], dtype=np.int64)
            at = np.minimum(np.searchsorted(ids, near), len(ids) - 1)
            lists.append(at[ids[at] == near])
        found = range_search(x, Graph(lists), least, size=size)
    else:
        found = (x @ x.T >= least) & (size[:, None] == size[None, :])
    a, b = np.nonzero(np.triu(found, 1))
    up = np.arange(len(ids))

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    # Each vector's smallest neighbour first; most groups are one after that.
    linked = np.full(len(ids), -1)
    for i, j in zip(a.tolist(), b.tolist()) if len(a) < 50_000 else _few(a, b, len(ids)):
        p, q = root(i), root(j)
        if p != q:
            up[max(p, q)] = min(p, q)
    for i in range(len(ids)):
        linked[i] = root(i)
    common = (cells[a][:, :, None] == cells[b][:, None, :]).any(2) if len(a) else np.zeros((0, 1), bool)
    smallest = np.where(common, cells[a], np.iinfo(np.int32).max).min(1) if len(a) else np.empty(0)
    mine = (smallest == cell) & (np.minimum(block[a], block[b]) == low) & (np.maximum(block[a], block[b]) == high)
    count = np.bincount(np.concatenate([a[mine], b[mine]]), minlength=len(ids))
    some = np.flatnonzero((count > 0) | (linked != np.arange(len(ids))))
    return pa.table({"vec_id": pa.array(ids[some]), "n": pa.array(count[some], pa.int64()), "root": pa.array(ids[linked[some]])})


def _few(a: np.ndarray, b: np.ndarray, n: int) -> Iterator[tuple[int, int]]:
    """Enough of many pairs for the same components, by repeated minima over neighbours."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            return iter([(i, int(r)) for i, r in enumerate(label) if r != i])


def _searched(assigned: DataFrame, least: float, cap: int) -> DataFrame:
    """``vec_id, n, root`` from all shards."""
    shards = _shards(assigned, cap)

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("vec_id")
        ids = group.column("vec_id").to_numpy()
        lists = robust_graph(matrix(group.column("vector")))
        return pa.table({"vec_id": pa.array(ids), "near": pa.array([ids[x] for x in lists], pa.list_(pa.int64()))})

    edges = shards.groupBy("shard").applyInArrow(build, "vec_id long, near array<long>")
    united = edges.groupBy("vec_id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    united = materialise(united, "graph-edges")
    searched = shards.join(united, "vec_id").groupBy("shard").applyInArrow(
        lambda group: _links_of(group, least), "vec_id long, n long, root long"
    )
    return materialise(searched, "graph-links")


def _compared(vectors: DataFrame, least: float, cap: int) -> DataFrame:
    """``vec_id, n, root`` from all pairs of blocks: one cell holds every vector."""
    shards = _shards(vectors.withColumn("cells", F.array(F.lit(0))), cap)
    compared = shards.groupBy("shard").applyInArrow(lambda group: _links_of(group, least), "vec_id long, n long, root long")
    return materialise(compared, "graph-links")


def audited(vectors: DataFrame, least: float = LINK, block: int = AUDIT) -> DataFrame:
    """``vec_id, n``: exact numbers of links of all ids divisible by ``EVERY``, a block of them at a time."""
    return exact_counts(vectors, vectors.filter(F.col("vec_id") % EVERY == 0), least, block)


def exact_counts(vectors: DataFrame, asked: DataFrame, least: float = LINK, block: int = AUDIT) -> DataFrame:
    """``vec_id, n`` of the vectors of ``asked`` against all, about ``block`` of them at a time."""
    asked = materialise(asked, "graph-audit")
    parts = max(1, -(-asked.count() // block))
    place = F.pmod(F.xxhash64("vec_id", F.lit("audit")), F.lit(parts))
    counted = [materialise(brute_force(vectors, asked.filter(place == k), least), "graph-exact") for k in range(parts)]
    return reduce(DataFrame.unionByName, counted)


def recall_of(exact: DataFrame, counts: DataFrame, large: int = PER_CELL) -> float | None:
    """The average share of links found per audited vector that has any; the lower one of all and of those with at most ``large``.

    None if no audited vector has a link: nothing is known of the recall then.
    """
    share = F.least(F.col("n"), F.coalesce("n_links", F.lit(0))) / F.col("n")
    row = exact.filter("n > 0").join(counts, "vec_id", "left").agg(
        F.avg(share).alias("all"), F.avg(F.when(F.col("n") <= large, share)).alias("small")
    ).first()
    return min((x for x in row if x is not None), default=None)


def brute_force(vectors: DataFrame, queries: DataFrame, least: float = LINK) -> DataFrame:
    """``vec_id, n``: exact numbers of links of the queries (a bounded table) against all vectors."""
    picked = queries.toArrow()
    ids, packed, size = picked.column("vec_id").to_numpy(), matrix(picked.column("vector")), lengths(picked.column("vector"))
    shared = vectors.sparkSession.sparkContext.broadcast((ids, packed, size))

    def count(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, q, size = shared.value
        total = np.zeros(len(own), np.int64)
        for chunk in chunks:
            if not chunk.num_rows or not len(own):
                continue
            x = matrix(chunk.column("vector"))
            wide = min(x.shape[1], q.shape[1])
            near = (q[:, :wide] @ x[:, :wide].T >= least) & (own[:, None] != chunk.column("vec_id").to_numpy()[None, :])
            near &= size[:, None] == lengths(chunk.column("vector"))[None, :]
            total += near.sum(1)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total)], names=["vec_id", "n"])

    return vectors.select("vec_id", "vector").mapInArrow(count, "vec_id long, n long").groupBy("vec_id").agg(F.sum("n").alias("n"))


def find(vectors: DataFrame, least: float = LINK, overlap: int = OVERLAP, recall: float = RECALL, per_cell: int = PER_CELL, cap: int = CAP) -> DataFrame:
    """``vec_id, n_links, component_id, kept, audited_recall``: one row per input row.

    A vector that is null, empty, zero, or holds a null or a number that is not finite, links nothing; so does a row
    without an id, whose component is null and which is kept. Rows that repeat an id are one vector (the smallest by its
    bytes) and get the same figures. Vectors of different lengths have no cosine and are not linked. ``audited_recall`` is
    null where no link is there to be found. Labels and other columns are not looked at.
    """
    prepare(vectors.sparkSession)
    usable = materialise(_valid(vectors), "graph-vectors")
    n = usable.count()
    middle = centroids(usable, n, per_cell)
    exact = audited(usable, least)
    blocks = -(-n // (cap // 2))  # how often the comparison of all pairs of blocks copies a vector
    while True:
        searched = _searched(materialise(_assigned(usable, middle, overlap), "graph-cells"), least, cap)
        counts = searched.groupBy("vec_id").agg(F.sum("n").alias("n_links"))
        reached = recall_of(exact, counts, per_cell)
        if reached is None:
            some = materialise(counts.filter("n_links > 0").orderBy(F.xxhash64("vec_id"), "vec_id").limit(AUDIT).select("vec_id"), "graph-linked")
            further = exact_counts(usable, usable.join(some, "vec_id", "left_semi"), least)
            reached = recall_of(further, counts, per_cell)
            if reached is not None:
                exact = further
        if reached is None or reached >= recall:
            break
        if 2 * overlap >= min(len(middle), blocks):
            searched = _compared(usable, least, cap)
            counts = searched.groupBy("vec_id").agg(F.sum("n").alias("n_links"))
            reached = recall_of(exact, counts, per_cell)
            break
        overlap *= 2
    forest = searched.select(F.col("vec_id").alias("a"), F.col("root").alias("b")).filter("a <> b")
    groups = components(forest).withColumnRenamed("node", "vec_id")
    rows = vectors.select(F.col("vec_id").cast("long")).join(counts, "vec_id", "left").join(groups, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return rows.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"), F.lit(reached).cast("double").alias("audited_recall"),
    )
