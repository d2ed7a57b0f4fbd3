"""Exact substring dedup by fixed-block anchors.

Repeats are windows of ``WINDOW`` words. Each document is cut into blocks of half a window; any window then covers a
whole block, so of two equal windows one holds an anchor that the other meets as a rolling window of a block's length.
The work is done on packed hashes, in five steps that share one exchange of the texts:

1. Texts are dealt to units of about ``UNIT_BYTES`` by a hash of the row. Each unit sends, to as many buckets as the data
   ask for, 32 bits of the hash of every rolling window of a block's length, and one bit that says whether it begins a block.
2. A bucket marks the windows that meet an anchor other than themselves, and returns one bit for each window.
3. The unit extends its marked windows to all full windows that contain them: the candidates. Their 128-bit hashes
   go to buckets again.
4. A bucket marks the candidates that start in more than one place.
5. The unit joins overlapping marked windows to maximal repeats, removes what they cover and returns the digests.

Half-window hashes only choose candidates (a false one costs time, not correctness); repeats are decided on 128 bits.
No list of documents is formed for a passage, however many share it: a unit sends a hash once, with a bit for "more than
once here", so even a hash that fills the corpus reaches its bucket at most once a unit.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import parts_for, prepare, words

WINDOW = 35
UNIT_BYTES = 2_000_000  # text of a unit; one document is never split
BUCKET_KEYS = 2_000_000  # hashes of a bucket

_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _rolling(ids: np.ndarray, n: int, base: np.uint64, at: np.ndarray) -> np.ndarray:
    """A hash of the runs of ``n`` word hashes that begin at the places ``at``: polynomials modulo 2^64 by prefix sums."""
    powers = np.full(len(ids) + 1, base, dtype=np.uint64)
    back = np.full(len(ids) + 1, pow(int(base), -1, 1 << 64), dtype=np.uint64)
    powers[0] = back[0] = 1
    powers, back = np.multiply.accumulate(powers), np.multiply.accumulate(back)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(ids * powers[:-1], dtype=np.uint64)])
    return _mix((sums[at + n] - sums[at]) * back[at])


class Unit:
    """The words of a unit's documents as one array of hashes, with a place for every window that lies in one document."""

    def __init__(self, texts: list[str | None], window: int):
        self.window, self.block = window, (window + 1) // 2
        self.words = [words(t) for t in texts]
        sizes = np.array([len(w) for w in self.words], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        hashes = map(xxhash.xxh3_64_intdigest, chain.from_iterable(self.words))
        self.ids = _mix(np.fromiter(hashes, dtype=np.uint64, count=int(sizes.sum())))

    def places(self, length: int) -> np.ndarray:
        """Starts of the runs of ``length`` words that lie in one document of at least a window."""
        n = len(self.ids)
        ends = np.repeat(self.starts[1:], np.diff(self.starts))
        enough = np.repeat(np.diff(self.starts) >= self.window, np.diff(self.starts))
        return np.flatnonzero(enough & (np.arange(n) + length <= ends))

    def probes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, hashes and anchor bits of all windows of a block's length."""
        at = self.places(self.block)
        if not len(at):
            return at, np.empty(0, np.uint64), np.empty(0, bool)
        first = np.repeat(self.starts[:-1], np.diff(self.starts))
        return at, _rolling(self.ids, self.block, _P, at), (at - first[at]) % self.block == 0

    def candidates(self, hits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the full windows that contain a hit, and two hashes of each."""
        at = self.places(self.window)
        if not len(at) or not len(hits):
            return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
        hit = np.zeros(len(self.ids) + 1, dtype=np.int64)
        hit[hits + 1] = 1
        before = np.cumsum(hit)  # hits at places below
        at = at[before[at + self.window - self.block + 1] > before[at]]
        return at, _rolling(self.ids, self.window, _P, at), _rolling(self.ids, self.window, _Q, at)

    def covered(self, repeats: np.ndarray) -> np.ndarray:
        """Which words stand in a repeated window."""
        edge = np.zeros(len(self.ids) + 1, dtype=np.int64)
        np.add.at(edge, repeats, 1)
        np.add.at(edge, repeats + self.window, -1)
        return np.cumsum(edge[:-1]) > 0


class Sent:
    """Distinct hashes of a unit in ascending order, dealt to buckets by their high bits; ``of`` leads back to the places."""

    def __init__(self, first: np.ndarray, buckets: int, second: np.ndarray | None = None, anchor: np.ndarray | None = None):
        order = np.argsort(first) if second is None else np.lexsort((second, first))
        new = np.ones(len(first), bool)
        new[1:] = first[order][1:] != first[order][:-1]
        if second is not None:
            new[1:] |= second[order][1:] != second[order][:-1]
        self.of = np.empty(len(first), np.int64)
        self.of[order] = np.cumsum(new) - 1
        kept = order[new]
        self.first, self.second = first[kept], None if second is None else second[kept]
        self.many = np.bincount(self.of, minlength=len(kept)) > 1
        self.anchor = np.zeros(len(kept), bool) if anchor is None else np.bincount(self.of, anchor, len(kept)) > 0
        bucket = ((self.first >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        self.cuts = np.searchsorted(bucket, np.arange(buckets + 1).astype(np.uint64))

    def table(self, unit: int) -> pa.Table:
        """A row per bucket: low halves of the hashes (both hashes in the second exchange) and two bits for each."""
        rows = [b for b in range(len(self.cuts) - 1) if self.cuts[b + 1] > self.cuts[b]]
        parts = [slice(self.cuts[b], self.cuts[b + 1]) for b in rows]
        keys = self.first.astype(np.uint32) if self.second is None else np.column_stack([self.first, self.second])
        packed = [[x[p].tobytes() if x is keys else np.packbits(x[p]).tobytes() for p in parts] for x in (keys, self.many, self.anchor)]
        return pa.table([pa.array([unit] * len(rows), pa.int64()), pa.array(rows, pa.int64()), *(pa.array(x, pa.binary()) for x in packed)], schema=_SENT)

    def marked(self, replies: pa.Table) -> np.ndarray:
        """The buckets' bit for every place."""
        out = np.zeros(len(self.first), bool)
        for bucket, bits in zip(replies.column("bucket").to_pylist(), replies.column("bits").to_pylist()):
            a, b = self.cuts[bucket], self.cuts[bucket + 1]
            out[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=int(b - a)).astype(bool)
        return out[self.of]


def met(keys: np.ndarray, many: np.ndarray, anchor: np.ndarray | None) -> np.ndarray:
    """Which hashes (rows of one or two numbers) occur more than once and, with anchors, at one of them."""
    if not len(keys):
        return np.empty(0, bool)
    order = np.lexsort(keys.T[::-1])
    run = np.concatenate([[0], np.cumsum((keys[order][1:] != keys[order][:-1]).any(1))])
    found = np.bincount(run, 1 + many[order]) > 1
    if anchor is not None:
        found &= np.bincount(run, anchor[order]) > 0
    out = np.empty(len(keys), bool)
    out[order] = found[run]
    return out


_SENT = pa.schema([("unit", pa.int64()), ("bucket", pa.int64()), ("keys", pa.binary()), ("many", pa.binary()), ("anchor", pa.binary())])
_BACK = pa.schema([("unit", pa.int64()), ("bucket", pa.int64()), ("bits", pa.binary())])
SENT, BACK = "unit long, bucket long, keys binary, many binary, anchor binary", "unit long, bucket long, bits binary"


def remove_repeats(docs: DataFrame, window: int = WINDOW, unit_bytes: int = UNIT_BYTES, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text``: one row per input row.

    Words covered by a window that starts anywhere else too are removed, every copy of it; the rest is joined by spaces.
    A null or empty text, or one without words, keeps an empty text; a text shorter than a window loses nothing. Rows
    that repeat an id count as different places. Columns other than doc_id and text are not looked at.
    """
    spark = prepare(docs.sparkSession)
    size = docs.select(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0  # one row
    units, buckets = max(1, round(size / unit_bytes)), max(1, round(size / 6 / bucket_keys))
    tasks = parts_for(spark, size, 16 * unit_bytes)
    spread = docs.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(units)).alias("unit"), F.col("doc_id").cast("long"), "text"
    ).repartition(tasks, "unit")

    def rows_of(group: pa.Table) -> tuple[int, pa.Table, Unit]:
        """A unit's rows in an order that does not depend on how they arrived; equal rows are interchangeable."""
        digest = [xxhash.xxh3_64_intdigest(t.as_buffer() if t.is_valid else b"") for t in group.column("text").combine_chunks()]
        ids = group.column("doc_id").to_pylist()
        place = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, digest[i]))
        group = group.take(pa.array(place, pa.int64()))
        return group.column("unit")[0].as_py(), group, Unit(group.column("text").to_pylist(), window)

    def probed(made: Unit) -> tuple[np.ndarray, Sent]:
        at, hashes, anchor = made.probes()
        return at, Sent(hashes, buckets, anchor=anchor)

    def extended(made: Unit, replies: pa.Table) -> tuple[np.ndarray, Sent]:
        at, sent = probed(made)
        at, first, second = made.candidates(at[sent.marked(replies)])
        return at, Sent(first, buckets, second)

    def probe(group: pa.Table) -> pa.Table:
        unit, _, made = rows_of(group)
        return probed(made)[1].table(unit)

    def extend(group: pa.Table, replies: pa.Table) -> pa.Table:
        unit, _, made = rows_of(group)
        return extended(made, replies)[1].table(unit)

    def answer(width: int):
        def bits(group: pa.Table) -> pa.Table:
            keys = [np.frombuffer(k, np.uint32 if width == 1 else np.uint64).reshape(-1, width) for k in group.column("keys").to_pylist()]
            many, anchor = (
                np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=len(k)) for m, k in zip(group.column(c).to_pylist(), keys)])
                for c in ("many", "anchor")
            )
            found = met(np.concatenate(keys), many, anchor if width == 1 else None)
            parts = [np.packbits(x).tobytes() for x in np.split(found, np.cumsum([len(k) for k in keys])[:-1])]
            return pa.table([group.column("unit"), group.column("bucket"), pa.array(parts, pa.binary())], schema=_BACK)

        return bits

    def cut(group: pa.Table, replies: pa.Table) -> pa.Table:
        _, group, made = rows_of(group)
        first = pc.equal(replies.column("step"), 1)
        at, sent = extended(made, replies.filter(first))
        gone = made.covered(at[sent.marked(replies.filter(pc.invert(first)))])
        texts, removed = [], []
        for k, own in enumerate(made.words):
            mask = gone[made.starts[k] : made.starts[k + 1]]
            removed.append(int(mask.sum()))
            kept = [own[i] for i in np.flatnonzero(~mask)] if removed[-1] else own
            texts.append(b" ".join(kept).decode("utf-8", "surrogatepass"))
        return pa.table({
            "doc_id": group.column("doc_id"), "n_words": pa.array([len(w) for w in made.words], pa.int64()),
            "n_removed": pa.array(removed, pa.int64()), "kept_text": pa.array(texts, pa.string()),
        })

    # One plan: the exchange of the texts, and that of the first replies, are made once and read by each step.
    by_unit = spread.groupBy("unit")
    hits = by_unit.applyInArrow(probe, SENT).groupBy("bucket").applyInArrow(answer(1), BACK)
    windows = by_unit.cogroup(hits.groupBy("unit")).applyInArrow(extend, SENT)
    repeats = windows.groupBy("bucket").applyInArrow(answer(2), BACK)
    replies = hits.withColumn("step", F.lit(1)).unionByName(repeats.withColumn("step", F.lit(2)))
    return by_unit.cogroup(replies.groupBy("unit")).applyInArrow(cut, "doc_id long, n_words long, n_removed long, kept_text string")
