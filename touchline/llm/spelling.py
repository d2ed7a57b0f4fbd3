"""Grouping of spelling variants by Bloom-guided neighbourhoods.

1. Words are counted; a task adds up what it reads before anything is shuffled.
2. The vocabulary goes into blocked Bloom filters: one filter for each length of word, 16 bits a word, each word in one
   block of 64 bits. A filter is cut into segments of blocks, so that no task builds more than ``SEGMENT_BLOCKS`` of them.
3. The filters are broadcast in rounds of at most ``ROUND_BYTES``: the bound holds at any size, a vocabulary of some 30
   million words takes one round, a larger one more. In each round every word generates the edits that one of each two near
   words can make of itself (each deletion, and each replacement by a larger letter) and probes the filter of the edit's length.
4. Only edits that a filter knows are shuffled, to an exact join with the vocabulary that removes the filter's errors.
5. Each word's near words are reduced to their number and its form by one aggregate; roots come from pointer doubling.
   A form is at least twice as frequent, so chains have at most 63 steps and are settled in six joins.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import batches, materialise, prepare
from touchline.llm.windows import mix, slices

LEAST_CHARS, LEAST_COUNT, FACTOR, TYPO = 5, 3, 2, 97  # fixed by the contract
ALPHABET = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]  # what a lower-cased run consists of
SEGMENT_BLOCKS = 1 << 20  # 8 MB of a filter
ROUND_BYTES = 64_000_000
EDITS = 2_000_000  # edits probed at a time

_RUN = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")  # UTF-8 of [a-zÀ-ÿ]+
_BASE = 0x9E3779B97F4A7C15
_BACK = np.uint64(pow(_BASE, -1, 1 << 64))


def vocabulary(docs: DataFrame, typo: int = 0, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n``: runs of letters of all texts, A-Z lower-cased, that are long and frequent enough.

    With ``typo``, a run whose ``<doc_id>:<run>`` has a crc32 that ``typo`` divides loses one code point first; rows without
    id are not changed. A null text has no runs; repeated rows count as often as they are there.
    """
    prepare(docs.sparkSession)
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(parts):
            seen: Counter[bytes] = Counter()
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                runs = _RUN.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []
                if typo and doc_id is not None:
                    begin = crc32(b"%d:" % doc_id)
                    for k, h in enumerate([crc32(run, begin) for run in runs]):
                        if h % typo == 0:
                            chars = runs[k].decode()
                            at = h % len(chars)
                            runs[k] = (chars[:at] + chars[at + 1 :]).encode()
                seen.update(runs)
            texts = ((run.decode(), n) for run, n in seen.items())
            yield from batches(((word, n) for word, n in texts if len(word) >= least_chars), schema, 50_000)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def matrix(words: list[str]) -> np.ndarray:
    """The code points of words of one length, a row for each."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), -1).astype(np.uint64)


def powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def place(sums: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block and four bits within it for words with these polynomials."""
    h = mix(sums)
    block = ((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    bits = np.zeros(h.shape, np.uint64)
    for k in range(4):
        bits |= np.uint64(1) << ((h >> np.uint64(6 * k)) & np.uint64(63))
    return block, bits


def by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """Each length with the rows that have it."""
    sizes = np.array([len(w) for w in words], np.int64)
    for size in np.unique(sizes).tolist():
        yield size, np.flatnonzero(sizes == size)


class Filters:
    """The blocks that a round broadcasts: of each length, blocks ``[first, first + len)`` out of ``total``."""

    def __init__(self, totals: dict[int, int], segments: list[tuple[int, int, bytes]]):
        self.totals, self.parts = totals, {}
        for size in sorted({s[0] for s in segments}):
            own = sorted(s for s in segments if s[0] == size)
            self.parts[size] = (own[0][1] * SEGMENT_BLOCKS, np.concatenate([np.frombuffer(b, np.uint64) for *_, b in own]))

    def has(self, size: int, sums: np.ndarray) -> np.ndarray:
        if size not in self.parts:
            return np.zeros(sums.shape, bool)
        first, held = self.parts[size]
        block, bits = place(sums, self.totals[size])
        block = block.astype(np.int64) - first
        inside = (block >= 0) & (block < len(held))
        found = held[np.where(inside, block, 0)]
        return inside & ((found & bits) == bits)


def edits(words: list[str], size: int, filters: Filters) -> Iterator[tuple[int, str]]:
    """Row and result of the deletions and upward replacements of words of one length that the filters may know."""
    letters = np.array(ALPHABET, np.uint64)
    step = max(1, EDITS // (size * len(letters)))
    span = max(1, EDITS // len(letters))  # places of one word at a time
    power = powers(size)
    for begin in range(0, len(words), step):
        own = words[begin : begin + step]
        chars = matrix(own)
        before = np.cumsum(chars * power, axis=1, dtype=np.uint64)
        whole, before = before[:, -1:], np.concatenate([np.zeros((len(own), 1), np.uint64), before], axis=1)
        shorter = before[:, :-1] + (whole - before[:, 1:]) * _BACK
        hit = filters.has(size - 1, shorter)
        hit[:, 1:] &= chars[:, 1:] != chars[:, :-1]  # equal neighbours: the first deletion stands for all
        for row, k in zip(*(x.tolist() for x in np.nonzero(hit))):
            yield begin + row, own[row][:k] + own[row][k + 1 :]
        for a in range(0, size, span):
            old, base = chars[:, a : a + span, None], power[None, a : a + span, None]
            hit = filters.has(size, whole[:, :, None] + (letters - old) * base) & (letters > old)
            for row, k, c in zip(*(x.tolist() for x in np.nonzero(hit))):
                yield begin + row, own[row][: a + k] + chr(ALPHABET[c]) + own[row][a + k + 1 :]


def near_pairs(vocab: DataFrame) -> DataFrame:
    """``word, n, other, m``: each two words of ``word, n`` that one inserted, deleted or replaced code point tells apart, once.

    ``vocab`` has distinct words without nulls. A replacement is found if both code points are of ``ALPHABET``.
    """
    spark = prepare(vocab.sparkSession)
    sizes = {r["size"]: r["n"] for r in vocab.groupBy(F.length("word").alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per length
    totals = {size: max(1, -(-n // 4)) for size, n in sizes.items() if size}

    def located(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("size", pa.int64()), ("segment", pa.int64()), ("block", pa.int64()), ("bits", pa.int64())])
        for batch in parts:
            words = batch.column(0).to_pylist()
            for size, rows in by_length(words):
                if size:
                    block, bits = place((matrix([words[r] for r in rows]) * powers(size)).sum(axis=1, dtype=np.uint64), totals[size])
                    block = block.astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), size)), pa.array(block // SEGMENT_BLOCKS), pa.array(block % SEGMENT_BLOCKS), pa.array(bits.view(np.int64))], schema=schema)

    def build(group: pa.Table) -> pa.Table:
        size, segment = group.column("size")[0].as_py(), group.column("segment")[0].as_py()
        held = np.zeros(min(SEGMENT_BLOCKS, totals[size] - segment * SEGMENT_BLOCKS), np.uint64)
        np.bitwise_or.at(held, group.column("block").to_numpy(), group.column("bits").to_numpy().view(np.uint64))
        return pa.table({"size": [size], "segment": [segment], "held": pa.array([held.tobytes()], pa.binary())})

    blocks = vocab.select("word").mapInArrow(located, "size long, segment long, block long, bits long")
    filters = blocks.groupBy("size", "segment").applyInArrow(build, "size long, segment long, held binary")
    segments = [(size, k, 8 * min(SEGMENT_BLOCKS, n - k * SEGMENT_BLOCKS)) for size, n in sorted(totals.items()) for k in range(-(-n // SEGMENT_BLOCKS))]
    found = []
    if len(rounds := list(packed(segments))) > 1:
        filters = materialise(filters, "filters")
    for own in rounds:
        keys = F.broadcast(spark.createDataFrame(own, "size long, segment long"))
        held = spark.sparkContext.broadcast(Filters(totals, [tuple(r) for r in filters.join(keys, ["size", "segment"], "left_semi").collect()]))  # at most ROUND_BYTES

        def probe(parts: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("other", pa.string())])
            for batch in parts:
                words, n = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                for size, rows in by_length(words):
                    if size:
                        hits = edits([words[r] for r in rows], size, held.value)
                        yield from batches(((words[rows[r]], n[rows[r]], other) for r, other in hits), schema, 20_000)

        found.append(vocab.select("word", "n").mapInArrow(probe, "word string, n long, other string"))
    if not found:
        return vocab.limit(0).selectExpr("word", "n", "word AS other", "n AS m")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.join(vocab.selectExpr("word AS other", "n AS m"), "other").select("word", "n", "other", "m")


def packed(segments: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int]]]:
    """Segments in rounds of at most ``ROUND_BYTES``; neighbouring segments of a length stay together or go to the next round."""
    own, size = [], 0
    for length, k, held in segments:
        if own and size + held > ROUND_BYTES:
            yield own
            own, size = [], 0
        own.append((length, k))
        size += held
    if own:
        yield own


def variants(vocab: DataFrame, factor: int = FACTOR) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: one row per word of ``word, n``.

    A word's form is its most frequent near word (ties: the smallest by code points), if that is at least ``factor`` (2 or
    more) times as frequent; its root is the last form that forms lead to, the word itself if it has none. ``vocab`` has
    distinct words without nulls; without rows there is no result.
    """
    vocab = materialise(vocab.select("word", "n"), "vocabulary")
    pairs = materialise(near_pairs(vocab), "near")
    both = pairs.unionByName(pairs.selectExpr("other AS word", "m AS n", "word AS other", "n AS m"))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), F.col("other"))).alias("best"))
    enough = -F.col("best.less") >= factor * F.col("n")
    judged = vocab.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"),
    )
    judged = materialise(judged, "forms")
    ends = roots(judged.filter("form IS NOT NULL").select("word", F.col("form").alias("up")))
    out = judged.join(ends.withColumnRenamed("up", "root"), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(links: DataFrame) -> DataFrame:
    """``word, up`` with ``up`` as far as links without cycles lead: each round doubles the steps behind a link."""
    links = materialise(links, "links")
    while True:
        further = links.selectExpr("word AS up", "up AS next")
        moved = links.join(further, "up", "left").select("word", F.coalesce("next", "up").alias("up"), F.col("next").isNotNull().alias("more"))
        moved = materialise(moved, "links")
        links = moved.select("word", "up")
        if not moved.filter("more").limit(1).count():
            return links


# The table of crc32, and the crc32 of a string of hexadecimal digits, as SQL.
CRC_TABLE = """
  SELECT list(list_reduce([b::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END) ORDER BY b) AS t
  FROM range(256) AS r(b)"""
CRC_OF = """xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, length({h}), 2), lambda i: ('0x' || {h}[i : i + 1])::UBIGINT)),
    lambda c, b: xor(t[(xor(c, b) & 255)::INT + 1], c >> 8)), 4294967295::UBIGINT)"""

SPELLING_SQL = rf"""
WITH RECURSIVE crc AS ({CRC_TABLE}
), runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), per_run AS (
  SELECT doc_id, run, count(*) AS n, hex(encode(doc_id::VARCHAR || ':' || run)) AS h FROM runs GROUP BY ALL
), hashed AS (
  SELECT run, n, {CRC_OF.format(h='h')} AS crc32
  FROM per_run, crc
), changed AS (
  SELECT CASE WHEN crc32 % {TYPO} = 0
    THEN substr(run, 1, (crc32 % length(run))::INT) || substr(run, (crc32 % length(run))::INT + 2) ELSE run END AS word, n
  FROM hashed
), vocab AS (
  SELECT word, sum(n)::BIGINT AS n FROM changed WHERE length(word) >= {LEAST_CHARS} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}
), places AS (
  SELECT word, unnest(range(1, length(word) + 1)) AS k FROM vocab
), holes AS (
  SELECT word, k, substr(word, 1, k - 1) AS a, substr(word, k + 1) AS z FROM places
), near AS (
  SELECT l.word, r.word AS other FROM holes l JOIN holes r ON l.k = r.k AND l.a = r.a AND l.z = r.z AND l.word <> r.word
  UNION SELECT h.word, v.word FROM holes h JOIN vocab v ON h.a || h.z = v.word
  UNION SELECT v.word, h.word FROM holes h JOIN vocab v ON h.a || h.z = v.word
), best AS (
  SELECT near.word, count(*) AS n_near, min(struct_pack(less := -o.n, other := o.word)) AS b
  FROM near JOIN vocab o ON o.word = near.other GROUP BY near.word
), judged AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.less >= {FACTOR} * n THEN b.other END AS form,
    CASE WHEN -b.less >= {FACTOR} * n THEN -b.less END AS form_n
  FROM vocab LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS tip FROM judged
  UNION ALL SELECT walk.word, judged.form FROM walk JOIN judged ON judged.word = walk.tip WHERE judged.form IS NOT NULL
)
SELECT word, form, tip AS root, n, n_near, form_n
FROM walk JOIN judged USING (word) WHERE tip IN (SELECT word FROM judged WHERE form IS NULL)
"""
