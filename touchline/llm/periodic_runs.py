"""Periodic runs of words: maximal stretches that repeat a period at least three times.

Each text is searched by itself, in the task that reads it; nothing is shuffled.

1. Every window of eight words inside a run stands at least twice in it, a period apart (a run has 24 words and three
   periods at least). Words outside such stretches are left out, and so are windows whose nearest copy is farther than a
   third of their stretch: no run can reach over them. A run never crosses the border of a stretch.
2. On each stretch the first phase of Baier's suffix sorter: suffixes are grouped by the Lyndon word they begin with, the
   groups are taken from the largest down, and each one is appended to the group of the factor on its left. What a
   suffix has gathered when its group is taken is its longest Lyndon word, so groups and lengths are the Lyndon array; no
   suffix is sorted. This is done under the order of the words' numbers and under the reverse order.
3. By the runs theorem each run's Lyndon root is the longest Lyndon word at its start under one of the two orders. Equal
   neighbouring roots (same group, one length apart) are chained, and each chain is extended to both sides by longest common
   extensions, by comparing ever longer stretches of numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import WORD, prepare
from touchline.llm.spelling import CRC_OF, CRC_TABLE
from touchline.llm.windows import Coded, covered, slices

LEAST = 24  # words of a run
POWER = 3  # periods of a run
PROBE = 8  # window of the first step; see `probe_for`

RUNS = "array<struct<start:long,length:long,period:long>>"
_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()),
    ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("kept_text", pa.string()),
])


def lyndon_groups(codes: list[int], largest_first: bool = True) -> tuple[list[int], list[int]]:
    """For every place the length of the longest Lyndon word that starts there, and its group (equal words, equal groups).

    A word that is the beginning of another counts as smaller. ``largest_first=False`` reverses the order of the letters.
    """
    n = len(codes)
    letters = sorted(set(codes), reverse=not largest_first)
    rank = {c: g for g, c in enumerate(letters)}
    group = [rank[c] for c in codes]
    members: list[list[int]] = [[] for _ in letters]
    for i, g in enumerate(group):
        members[g].append(i)
    below = list(range(-1, len(letters) - 1))
    above = list(range(1, len(letters) + 1))
    length, left = [1] * n, list(range(-1, n - 1))
    g = len(letters) - 1
    while g >= 0:
        taken: dict[int, int] = {}  # how many factors of this group stand right after a smaller one
        size = 0
        for s in members[g]:
            if group[s] != g:  # it has grown since and is in another group
                continue
            p, size = left[s], length[s]
            if s + size < n:
                left[s + size] = p
            if p >= 0:
                taken[p] = taken.get(p, 0) + 1
        grown: dict[tuple[int, int], list[int]] = {}
        for p, k in taken.items():
            grown.setdefault((group[p], k), []).append(p)
        for (v, k), places in sorted(grown.items(), reverse=True):  # v < v u < v u u: each goes right above v
            new, over = len(members), above[v]
            members.append(places)
            below.append(v)
            above.append(over)
            above[v] = new
            if over < len(below):
                below[over] = new
            for p in places:
                group[p] = new
                length[p] += k * size
        g = below[g]
    return length, group


def stretch_runs(codes: np.ndarray, least: int = LEAST, power: int = POWER) -> set[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of one stretch of numbers."""
    found = set()
    for order in (True, False):
        size, group = map(np.array, lyndon_groups(codes.tolist(), order))
        at = np.flatnonzero(np.arange(len(codes)) + size < len(codes))
        at = at[group[at + size[at]] == group[at]]
        back = at - size[at]
        at = at[(back < 0) | (group[back] != group[at])]  # the first root of each chain
        for i, q in zip(at.tolist(), size[at].tolist()):
            last = i + q
            while last + q < len(codes) and group[last + q] == group[i]:
                last += q
            if last + q - i + 2 * (q - 1) < max(least, power * q):
                continue
            start = i - common(codes[:i][::-1], codes[: i + q][::-1])
            end = last + q + common(codes[last:], codes[last + q :])
            if end - start >= max(least, power * q):
                found.add((start, end - start, q))
    return found


def common(a: np.ndarray, b: np.ndarray) -> int:
    """How many numbers ``a`` and ``b`` begin with alike."""
    most, done, step = min(len(a), len(b)), 0, 16
    while done < most:
        differ = a[done : min(done + step, most)] != b[done : min(done + step, most)]
        if differ.any():
            return done + int(differ.argmax())
        done, step = min(done + step, most), 2 * step
    return most


def probe_for(least: int, power: int) -> int:
    """The longest window that stands twice in every run, each copy a period from the next: at most 64 words."""
    return max(1, min(64, *(max(least, power * q) - 2 * q + 1 for q in range(1, least + 1))))


def places(coded: Coded, least: int = LEAST, power: int = POWER) -> Iterator[tuple[int, int, int]]:
    """``(text, first, end)`` of every stretch of words that may hold runs; each run lies in one of them."""
    probe = probe_for(least, power)
    near = coded.repeats(probe)
    text = np.repeat(np.arange(len(coded.sizes)), coded.sizes)
    at = np.flatnonzero(near)
    while len(at):
        new = np.concatenate([[True], (np.diff(at) > 1) | (np.diff(text[at]) > 0)])
        number = np.cumsum(new) - 1
        size = np.bincount(number)[number] + probe - 1
        fits = (size >= least) & (power * near[at] <= size)
        if fits.all():
            first = at[new]
            for a, b in zip(first.tolist(), (first + np.bincount(number) + probe - 1).tolist()):
                yield int(text[a]), a, b
            return
        at = at[fits]


def runs_of(coded: Coded, least: int = LEAST, power: int = POWER) -> list[list[tuple[int, int, int]]]:
    """The runs of every text, by start and period; starts count from the text's first word."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in coded.words]
    for text, a, b in places(coded, least, power):
        shift = a - int(coded.starts[text])
        out[text] += [(s + shift, n, q) for s, n, q in stretch_runs(coded.codes[a:b], least, power)]
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def find(docs: DataFrame, least: int = LEAST, power: int = POWER) -> DataFrame:
    """``doc_id, n_words, runs, kept_text``: one row per input row.

    A run is a stretch of at least ``least`` words and ``power`` (3 or more) smallest periods that no neighbouring word
    extends; ``runs`` has all of them by start, then period. ``kept_text`` leaves out the words that a run holds after its
    first period, joined by spaces. A null or empty text, or one without words, has no runs and an empty text. Equal rows
    have equal results; every row is judged by itself. Columns other than doc_id and text are not looked at.
    """
    if power < 3 or least < power:
        raise ValueError("a chain needs two whole roots: runs have three periods at least")
    prepare(docs.sparkSession)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            coded = Coded(batch.column(1).to_pylist())
            every = runs_of(coded, least, power)
            texts = []
            for own, runs in zip(coded.words, every):
                if runs:
                    gone = covered(len(own), np.array([s + q for s, _, q in runs]), np.array([s + n for s, n, _ in runs]))
                    own = [own[i] for i in np.flatnonzero(~gone)]
                texts.append(b" ".join(own).decode("utf-8", "surrogatepass"))
            runs = [[dict(zip(("start", "length", "period"), r)) for r in own] for own in every]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(coded.sizes), pa.array(runs, _SCHEMA.field("runs").type), pa.array(texts)], schema=_SCHEMA)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(search, f"doc_id long, n_words long, runs {RUNS}, kept_text string")


def with_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` where the texts of a tenth of the ids become periodic from some word on (fixed by the contract).

    With h the crc32 of the id, g = h div 10 and n words: where h mod 10 is 0, the words from a = g mod n on repeat
    the first 1 + (n - a) div (3 + g mod 8) of them. Texts without words, and rows without id, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.floor(h / 10).alias("g"),
        F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("w"),
    )
    some = F.size("w") > 0
    own = own.withColumn("a", F.when(some, F.col("g") % F.size("w")).cast("int"))
    tail = F.size("w") - F.col("a")
    own = own.withColumn("p", F.when(some, 1 + F.floor(tail / (3 + F.col("g") % 8))).cast("int"))
    again = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil(tail / F.col("p")).cast("int")))
    made = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(again, F.lit(1), tail)), " ")
    return own.select("doc_id", F.when(some, made).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns out of :func:`find`: the run of greatest length / period, and hashes of runs and kept text."""

    def better(best: Column, run: Column) -> Column:
        larger = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | larger, run).otherwise(best)  # runs come by start, then period: ties keep the first

    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.aggregate("runs", none, better).alias("best"),
        F.sha2(text.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("kept_text").cast("binary"), 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


# Runs as maximal stretches of equal windows a period apart; the smallest period of a stretch counts.
RUNS_SQL = rf"""
WITH crc AS ({CRC_TABLE}
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w, hex(encode(doc_id::VARCHAR)) AS d FROM documents
), hashed AS (
  SELECT r, doc_id, w, len(w) AS n, {CRC_OF.format(h='d')} AS h FROM docs, crc
), shaped AS (
  SELECT r, doc_id, w, n, h, (h // 10 % greatest(n, 1))::BIGINT AS a, (h // 10 % 8)::BIGINT AS e FROM hashed
), own AS (
  SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(0, n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + e)) END]) ELSE w END AS w
  FROM shaped
), grams AS (
  SELECT r, n, k, w[k + 1 : k + 8] AS g FROM (SELECT r, n, w, unnest(range(0, n - 7)) AS k FROM own)
), pairs AS (
  SELECT x.r, x.k, y.k - x.k AS q FROM grams x JOIN grams y ON x.r = y.r AND x.g = y.g AND x.k < y.k AND {POWER} * (y.k - x.k) <= x.n
), islands AS (
  SELECT r, q, k, k - row_number() OVER (PARTITION BY r, q ORDER BY k) AS island FROM pairs
), stretches AS (
  SELECT r, q, min(k) AS s, count(*) + 7 + q AS l FROM islands GROUP BY r, q, island
), runs AS (
  SELECT r, s, l, min(q) AS q FROM stretches WHERE l >= greatest({LEAST}, {POWER} * q) GROUP BY r, s, l
), lists AS (
  SELECT r, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS listed,
    first(struct_pack(s := s, l := l, q := q) ORDER BY l / q DESC, s, q) AS b
  FROM runs GROUP BY r
), words AS (
  SELECT r, k, w[k + 1] AS word FROM (SELECT r, w, unnest(range(0, n)) AS k FROM own)
), gone AS (
  SELECT DISTINCT words.r, k FROM words JOIN runs ON runs.r = words.r AND k >= s + q AND k < s + l
), kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY k) AS text FROM words ANTI JOIN gone USING (r, k) GROUP BY r
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS start, b.l AS length, b.q AS period, 1000 * b.l // b.q AS exponent_milli,
  sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM own LEFT JOIN lists USING (r) LEFT JOIN kept USING (r)
"""
