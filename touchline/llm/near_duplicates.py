"""Near-duplicate documents by chosen-path set similarity join.

A document is its set of distinct word shingles; documents with the same set are one class. Every class carries
``SKETCH`` minwise tokens. A node of a chosen-path tree selects some paths of these positions; a class goes to the child
that its tokens along a path name. At the root a tree selects ``BRANCH`` paths of one token, so two sets of similarity s
meet with probability 1 - (1 - s)^BRANCH, 0.9966 at s = 0.85, and ``TREES`` independent trees miss one pair in 10^5.
Below, a node selects ``WAYS`` paths of ``STEPS`` tokens at once: two sets meet again with probability
1 - (1 - s^STEPS)^WAYS, 0.9999 at s = 0.85, while sets that share half of their shingles are in 0.3 children on average,
so that large nodes fall apart. Three things happen with the nodes:

1. In every root node each class is compared by sketch, with a margin of ``MARGIN`` standard errors, with the smallest
   one. Classes that are like the same one need no further comparison to be candidates together.
2. Nodes of at most ``LEAF`` classes are compared exhaustively by sketch; larger ones are branched. What may be linked
   forms candidate groups.
3. The full sets of the classes in candidate groups are read once. The pairs of step 1 are confirmed on them, which
   settles most groups of near copies; then every pair of a group that is not known to be connected is compared.
   Groups are dealt in pairs of blocks of ``BLOCK`` classes, so no task holds more, however many copies there are.

Only components are asked for, so links within a known component are not looked at again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import materialise, prepare, unused
from touchline.llm.components import components

SHINGLE = 5
SKETCH = 64  # minwise tokens of a class
TREES, BRANCH = 2, 3  # independent trees, paths of one token at their roots
WAYS, STEPS = 20, 6  # paths of a node below, and their tokens
LEAF = 4096  # nodes up to this size are compared exhaustively
DEPTH = 4  # levels after which what is left is compared whatever its size, in blocks
BLOCK = 512  # classes of a block
MARGIN = 5.0  # standard errors

_MULTIPLY = np.array([xxhash.xxh3_64_intdigest(f"minwise {i}".encode()) | 1 for i in range(SKETCH)], dtype=np.uint64)
_POWER = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(SHINGLE)], dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; one for a text of fewer words, none without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    if len(words) < n:
        return np.array([xxhash.xxh3_64_intdigest(b"short " + b" ".join(words))], dtype=np.uint64)
    ids = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    rows = len(ids) - n + 1
    out = np.zeros(rows, dtype=np.uint64)
    for k in range(n):
        out += _mix(ids[k : k + rows] + np.uint64(k)) * _POWER[k % SHINGLE]
    return np.unique(_mix(out))


def sketch(found: np.ndarray) -> np.ndarray:
    """The minwise tokens of a set, 32 bits each."""
    low = np.full(SKETCH, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(found), 2048):
        low = np.minimum(low, (found[i : i + 2048, None] * _MULTIPLY).min(0))
    return (low >> np.uint64(32)).astype(np.uint32).view(np.int32)


def set_key(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def _described(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, key, sketch`` of every row."""

    def describe(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks:
            n, keys, tokens = [], [], []
            for text in chunk.column(1):
                found = shingles(text.as_py())
                n.append(len(found))
                keys.append(set_key(found) if len(found) else None)
                tokens.append(sketch(found) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [chunk.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(tokens, pa.list_(pa.int32()))],
                names=["doc_id", "n_shingles", "key", "sketch"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        describe, "doc_id long, n_shingles long, key binary, sketch array<int>"
    )


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``class_id, items`` (packed hashes) for the classes of ``class_id, key``."""

    def pack(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks:
            ids, sets = [], []
            for class_id, key, text in zip(*(chunk.column(i) for i in range(3))):
                found = shingles(text.as_py())
                if set_key(found) == key.as_py():  # another row of this id may have another text
                    ids.append(class_id.as_py())
                    sets.append(found.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], names=["class_id", "items"])

    # The table of classes grows with the documents, so it is never broadcast, however small it is.
    texts = docs.select(F.col("doc_id").cast("long").alias("class_id"), "text").join(wanted.hint("merge"), "class_id")
    return texts.select("class_id", "key", "text").mapInArrow(pack, "class_id long, items binary").dropDuplicates(["class_id"])


def _confirmed(pairs: DataFrame, sets: DataFrame, top: int, bottom: int) -> DataFrame:
    """The pairs with bottom * intersection >= top * union on their full sets."""

    def compare(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks:
            keep = []
            for x, y in zip(chunk.column(2), chunk.column(3)):
                p, q = (np.frombuffer(z.as_buffer(), dtype=np.uint64) for z in (x, y))
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(bottom * both >= top * (len(p) + len(q) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([chunk.column(0).filter(mask), chunk.column(1).filter(mask)], names=["a", "b"])

    with_a = pairs.join(sets.select(F.col("class_id").alias("a"), F.col("items").alias("items_a")), "a")
    with_b = with_a.join(sets.select(F.col("class_id").alias("b"), F.col("items").alias("items_b")), "b")
    return with_b.select("a", "b", "items_a", "items_b").mapInArrow(compare, "a long, b long")


def _children(entries: DataFrame, ways: int, steps: int) -> DataFrame:
    """``node, class_id`` one level deeper: a child for each path of ``steps`` positions that the node selects."""
    way = F.explode(F.array(*map(F.lit, range(ways)))).alias("way")
    places = [F.pmod(F.xxhash64("node", "way", F.lit(i)), F.lit(SKETCH)).cast("int") for i in range(steps)]
    entries = entries.select("node", "class_id", "sketch", way)
    return entries.select(F.xxhash64("node", "way", *[F.get("sketch", p) for p in places]).alias("node"), "class_id")


def _alike(a: str, b: str, least: int) -> Column:
    same = F.aggregate(F.arrays_zip(F.col(a).alias("x"), F.col(b).alias("y")), F.lit(0), lambda n, z: n + (z["x"] == z["y"]).cast("int"))
    return same >= least


def _shared(entries: DataFrame) -> DataFrame:
    """Entries of nodes with at least two of them, with the node's smallest class."""
    sizes = entries.groupBy("node").agg(F.count(F.lit(1)).alias("count"), F.min("class_id").alias("lead")).filter("count > 1")
    return entries.join(sizes.drop("count"), "node")


def _sided(rows: DataFrame, group: str) -> DataFrame:
    """``rows`` (group, class_id, component, ..) of groups with several components: ``n`` and ``main`` are added.

    The largest component of a group is its main side (its size and number).
    """
    sides = rows.groupBy(group, "component").agg(F.count(F.lit(1)).alias("side"))
    sizes = sides.groupBy(group).agg(
        F.max(F.struct("side", "component")).alias("main"), F.sum("side").alias("n"), F.count(F.lit(1)).alias("sides")
    )
    return rows.join(sizes.filter("sides > 1").drop("sides"), group)


def _dealt(rows: DataFrame, group: str, block: int) -> DataFrame:
    """:func:`_sided` rows copied to pairs of blocks: ``task, own`` are added.

    Blocks hold either main classes or others, and two blocks of the main side never meet, since what they hold is
    connected already.
    """
    main = F.col("component") == F.col("main.component")
    others = F.ceil((F.col("n") - F.col("main.side")) / block).cast("long")
    blocks = F.ceil(F.col("main.side") / block).cast("long")
    place = F.xxhash64("class_id")
    own = F.when(main, others + F.pmod(place, blocks)).otherwise(F.pmod(place, F.greatest(others, F.lit(1))))
    rows = rows.withColumns({"own": own, "others": others, "all": others + blocks})
    meets = F.filter(F.sequence(F.lit(0).cast("long"), F.col("all") - 1), lambda o: (F.col("own") < F.col("others")) | (o < F.col("others")))
    rows = rows.withColumn("met", F.explode(meets))
    task = F.xxhash64(group, F.least("own", "met"), F.greatest("own", "met")).alias("task")
    return rows.select("*", task).drop("main", "n", "others", "all", "met", group)


def _nearest(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """``rows`` with the smallest class that a pair links each to as its component, else its own."""
    lead = pairs.groupBy(F.col("b").alias("class_id")).agg(F.min("a").alias("component"))
    return rows.join(lead, "class_id", "left").withColumn("component", F.coalesce("component", "class_id"))


class _Union:
    """Union-find over the rows of a task."""

    def __init__(self, component: np.ndarray):
        _, self.up = np.unique(component, return_inverse=True)
        self.at = self.up.copy()
        self.up = np.arange(self.up.max() + 1 if len(self.up) else 0)

    def root(self, i: int) -> int:
        r = self.at[i]
        while self.up[r] != r:
            self.up[r] = self.up[self.up[r]]
            r = self.up[r]
        return int(r)

    def join(self, i: int, j: int) -> bool:
        x, y = self.root(i), self.root(j)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _runs(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each task, from batches sorted by task (the first column)."""
    held: list[pa.RecordBatch] = []
    for chunk in chunks:
        if not chunk.num_rows:
            continue
        key = chunk.column(0).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        for a, b in zip(cuts, cuts[1:]):
            if held and held[-1].column(0)[0].as_py() != key[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(chunk.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _packed(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*rows) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _compared(dealt: DataFrame, payload: str, neighbours) -> DataFrame:
    """Links ``a, b`` that connect what ``neighbours(i, rows)`` says is alike, per task: a spanning forest of them."""

    def compare(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        for rows in _runs(chunks):
            ids, component, own = (rows.column(c).to_numpy() for c in ("class_id", "component", "own"))
            if len(ids) < 2:
                continue
            union, data = _Union(component), neighbours(rows.column(payload).combine_chunks())
            two = own.min() != own.max()
            for i in range(len(ids) - 1):
                later = np.flatnonzero(data(i))
                later = later[(later > i) & (component[later] != component[i])]
                if two:
                    later = later[own[later] != own[i]]
                found += [(int(ids[i]), int(ids[j])) for j in later.tolist() if union.join(i, j)]
            if len(found) > 5000:
                yield _packed(found)
                found = []
        yield _packed(found)

    spread = dealt.select("task", "class_id", "component", "own", payload).repartition("task").sortWithinPartitions("task")
    return spread.mapInArrow(compare, "a long, b long")


def _by_sketch(least: int):
    def prepared(column: pa.Array):
        tokens = column.flatten().to_numpy().reshape(-1, SKETCH)
        return lambda i: (tokens == tokens[i]).sum(1) >= least

    return prepared


def _by_set(top: int, bottom: int):
    def prepared(column: pa.Array):
        sets = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in column]
        sizes = np.array([len(x) for x in sets])
        _, flat = np.unique(np.concatenate(sets), return_inverse=True)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        mark = np.zeros(flat.max() + 1, dtype=np.int32)

        def alike(i: int) -> np.ndarray:
            mine = flat[starts[i] : starts[i] + sizes[i]]
            mark[mine] = 1
            both = np.add.reduceat(mark[flat], starts)
            mark[mine] = 0
            return bottom * both >= top * (sizes + sizes[i] - both)

        return alike

    return prepared


def _stars(entries: DataFrame, least: int) -> DataFrame:
    """Pairs of every class of a node with its smallest one, alike by sketch."""
    lead = entries.filter("class_id = lead").select("node", F.col("class_id").alias("a"), F.col("sketch").alias("sketch_a"))
    pairs = entries.filter("class_id <> lead").join(lead, "node").filter(_alike("sketch", "sketch_a", least))
    return pairs.select("a", F.col("class_id").alias("b")).distinct()  # the smaller class first


def find(docs: DataFrame, top: int = 85, bottom: int = 100) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: one row per input row; linked if bottom * both >= top * either.

    Null and empty texts have no shingles and stand alone. A row with a null id links nothing and has a null component;
    it is kept. Rows that repeat an id share its component if they share its set; other columns are not looked at.
    """
    prepare(docs.sparkSession)
    share = top / bottom
    least = max(1, math.ceil(SKETCH * share - MARGIN * math.sqrt(SKETCH * share * (1 - share))))
    rows = materialise(_described(docs), "near-rows")
    told = rows.filter("key IS NOT NULL AND doc_id IS NOT NULL")
    classes = told.groupBy("key").agg(F.min("doc_id").alias("class_id"), F.first("sketch").alias("sketch"))
    classes = materialise(classes, "near-classes")
    # An id with several texts may lead several classes; one of them stands for it.
    heads = materialise(classes.dropDuplicates(["class_id"]), "near-heads")
    sketches, keys = heads.select("class_id", "sketch"), heads.select("class_id", "key")

    tree = F.explode(F.array(*[F.lit(t).cast("long") for t in range(TREES)])).alias("node")
    entries = _shared(_children(heads.select(tree, "class_id", "sketch"), BRANCH, 1)).join(sketches, "class_id")
    entries = materialise(entries, "near-entries")
    stars = materialise(_stars(entries, least), "near-stars")
    maybe = stars
    for depth in range(DEPTH + 1):
        open_ = materialise(_sided(_nearest(entries, stars), "node"), "near-open")
        leaf = F.col("n") <= (LEAF if depth < DEPTH else 1 << 62)
        compared = _compared(_dealt(open_.filter(leaf), "node", LEAF), "sketch", _by_sketch(least))
        maybe = maybe.unionByName(materialise(compared, "near-maybe"))
        large = open_.filter(~leaf)
        if large.isEmpty():
            break
        entries = materialise(_shared(_children(large, WAYS, STEPS)).join(sketches, "class_id"), "near-entries")
    groups = components(maybe).select(F.col("node").alias("class_id"), F.col("component").alias("group"))
    sets = materialise(_sets(docs, materialise(groups.select("class_id").join(keys, "class_id"), "near-wanted")), "near-sets")
    links = materialise(_confirmed(stars, sets, top, bottom), "near-links")
    open_ = _sided(_nearest(groups, links), "group")
    more = _compared(_dealt(open_, "group", BLOCK).join(sets, "class_id"), "items", _by_set(top, bottom))
    known = components(links.unionByName(materialise(more, "near-links"))).select(F.col("node").alias("class_id"), "component")
    members = classes.select("key", "class_id").join(known, "class_id", "left")
    members = members.select("key", F.coalesce("component", "class_id").alias("component"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")
    done = rows.select("doc_id", "n_shingles", "key").join(members, "key", "left").select("doc_id", "n_shingles", component)
    return done.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, top: int = 4, bottom: int = 5) -> DataFrame:
    """``docs`` without the documents that another of their group stands for; rows without an id stay.

    Columns of any name may be there. Of rows that repeat an id all go or all stay.
    """
    gone = find(docs, top, bottom).filter("NOT kept").select("doc_id").distinct()
    name = unused(docs, "gone")
    gone = gone.withColumnRenamed("doc_id", name)
    return docs.join(gone, docs["doc_id"].cast("long") == gone[name], "left_anti")
