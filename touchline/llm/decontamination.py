"""Benchmark decontamination by template canonicalisation.

Numbers, units and names become typed placeholders (a run of names is one), everything else its lower-case word. Every
window of ``WINDOW`` canonical tokens of the benchmark is hashed, windows that are mostly placeholders with their tokens as
written, and the hashes of all windows of all documents are looked up in that index. The hits of a document on one diagonal
(place in the document less place in the item) make an alignment; alignments that lie within an item's length of the longest
one are read together, so a slot filled with more or fewer tokens does not cut a copy in two. In them the placeholders are
compared: the same value in the item must always meet the same value in the document. A re-worded number therefore
still counts, a table of unrelated numbers does not. A document is contaminated by an item if consistent windows cover
at least ``COVER`` of the item's tokens, or ``RUN`` consecutive tokens of it stand there as written.

The index is cut into blocks of at most ``BLOCK`` windows; each block is broadcast (a bounded size) and met by all
documents, so a benchmark of any size is searched whole and documents are never shuffled.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import batches, materialise, prepare

WINDOW = 8  # canonical tokens
COVER = 0.5  # share of an item's tokens under consistent windows
WORDY = 0.5  # a window with a smaller share of plain words is indexed as written
RUN = 50  # consecutive tokens as written that are enough of an item of any length
BLOCK = 200_000  # windows of a broadcast block

NUMBER, UNIT, NAME = "<number>", "<unit>", "<name>"
#: Fixed list: units that make a placeholder when they follow a number.
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles g kg mg lb lbs oz ton tons ml l litre litres liter liters "
    "s sec second seconds min minute minutes h hour hours day days week weeks month months year years hz khz mhz ghz "
    "dollar dollars cent cents euro euros percent degrees mph kmh w kw v".split()
)
_TOKEN = re.compile(r"[0-9]+(?:[.,:/][0-9]+)*|[^\W\d_]+|[%$€£°]")
_TOKEN_OR_STOP = re.compile(_TOKEN.pattern + r"|[.!?\n]")
_STOPS = frozenset(".!?\n")
_SENTENCE = re.compile(r"[.!?\n]")
_SIGNS = frozenset("%$€£°")
_IS_NUMBER, _IS_SIGN, _IS_STOP = -1, -2, -3
REMEMBERED = 500_000  # written tokens a task keeps the codes of


def canonical(text: str | None) -> list[tuple[str, str]]:
    """(canonical token, as written). A name is a run of capitalised words that do not begin a sentence or a line."""
    out, fresh, at = [], True, 0
    for m in _TOKEN.finditer(text or ""):
        token, between = m[0], text[at : m.start()]
        fresh = fresh if at == 0 else bool(_SENTENCE.search(between))
        if token[0].isdigit():
            kind = NUMBER
        elif token in _SIGNS or (out and out[-1][0] == NUMBER and token.lower() in UNITS):
            kind = UNIT
        elif token[0].isupper() and token[1:].islower() and not fresh:
            kind = NAME
        else:
            kind = token.lower()
        if kind == NAME and out and out[-1][0] == NAME:
            out[-1] = (NAME, f"{out[-1][1]} {token}")
        else:
            out.append((kind, token))
        at, fresh = m.end(), False
    return out


def item_windows(item_id: int, text: str | None, window: int = WINDOW) -> list[tuple[int, bool, list[str]]]:
    """(place, as written, tokens) of the windows to index: all of them; a shorter item is one window if it has three."""
    found = canonical(text)
    size = min(window, len(found))
    if size < min(window, 3):
        return []
    out = []
    for i in range(len(found) - size + 1):
        own = found[i : i + size]
        written = sum(kind[0] != "<" for kind, _ in own) < WORDY * size
        out.append((i, written, [token.lower() if written else kind for kind, token in own]))
    return out


class _Codes(dict):
    """Code of a token as written: eight times the number of its lower-case form, plus flags for case and unit."""

    def __init__(self, ids: dict[str, int]):
        super().__init__()
        self.ids = ids

    def __missing__(self, token: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        if token[0].isdigit():
            code = _IS_NUMBER
        elif token in _SIGNS:
            code = _IS_SIGN
        elif token in _STOPS:
            code = _IS_STOP
        else:
            low = token.lower()
            code = self.ids.get(low, 0) * 8 + (token[0].isupper() and token[1:].islower()) + 2 * (low in UNITS)
        self[token] = code
        return code


class Block:
    """A part of the index: tokens as numbers, the hashes of windows by kind and length, the items' tokens."""

    def __init__(self, rows: list[tuple[int, int, bool, list[str]]], items: dict[int, list[tuple[str, str]]]):
        self.ids: dict[str, int] = {NUMBER: 1, UNIT: 2, NAME: 3}
        self.written: dict[str, int] = {}
        self.items = items
        by_length = defaultdict(list)
        for item, place, written, tokens in rows:
            known = self.written if written else self.ids
            by_length[written, len(tokens)].append((item, place, [known.setdefault(t, len(known) + 1) for t in tokens]))
        self.index = {}
        for (written, n), found in by_length.items():
            keys = rolling(np.array([ids for _, _, ids in found], dtype=np.uint64).ravel(), n)[::n]
            places = defaultdict(list)
            for key, (item, place, _) in zip(keys.tolist(), found):
                places[key].append((item, place))
            self.index[written, n] = (np.unique(keys), dict(places))
        self.codes = _Codes(self.ids)

    def numbers(self, text: str) -> tuple[np.ndarray, list[str]]:
        """The numbers of the canonical tokens of a text (0: not in the index), without a loop over the tokens, and the
        tokens as written, of a run of names the first one."""
        tokens = _TOKEN_OR_STOP.findall(text)
        code = np.fromiter(map(self.codes.__getitem__, tokens), dtype=np.int64)
        stop = code == _IS_STOP
        fresh = np.concatenate([[True], stop[:-1]]) if len(code) else stop
        code, fresh, at = code[~stop], fresh[~stop], np.flatnonzero(~stop)
        number = code == _IS_NUMBER
        after_number = np.concatenate([[False], number[:-1]]) if len(code) else number
        out = code >> 3
        name = (code > 0) & (code & 1 == 1) & ~fresh
        unit = (code == _IS_SIGN) | ((code > 0) & (code & 2 == 2) & after_number)
        out[name] = self.ids[NAME]
        out[unit] = self.ids[UNIT]
        out[number] = self.ids[NUMBER]
        name &= ~unit
        stays = ~(name & np.concatenate([[False], name[:-1]])) if len(code) else name
        return out[stays].astype(np.uint64), [tokens[k] for k in at[stays]] if self.written else []

    def hits(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item, place in the item, place in the document, window length)."""
        ids, tokens = self.numbers(text)
        own = {False: ids}
        if self.written:
            # A name of several words never equals a token of a window as written by its first word alone: the slots decide.
            own[True] = np.fromiter((self.written.get(t.lower(), 0) for t in tokens), np.uint64, len(tokens))
        for (written, n), (keys, places) in self.index.items():
            ids = own[written]
            if len(ids) < n:
                continue
            blank = np.concatenate([[0], np.cumsum(ids == 0)])
            at = np.flatnonzero(blank[n:] == blank[:-n])  # windows of known tokens only
            if not len(at):
                continue
            hashes = rolling(ids, n)[at]
            near = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
            for i in np.flatnonzero(keys[near] == hashes).tolist():
                for item, place in places[int(hashes[i])]:
                    yield item, place, int(at[i]), n


def rolling(ids: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every run of ``n`` numbers."""
    mixed = (ids + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0x94D049BB133111EB)
    out = np.zeros(len(ids) - n + 1, dtype=np.uint64)
    for i in range(n):
        out = out * np.uint64(0x100000001B3) + mixed[i : i + len(out)]
    return out


def matches(text: str | None, block: Block, cover: float = COVER, run: int = RUN) -> list[tuple[int, int, float]]:
    """(item, consistent windows, covered share) of the items of a block that contaminate a text."""
    hits = list(block.hits(text)) if text else []
    if not hits:
        return []
    written = canonical(text)
    by_item: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
    for item, place, at, n in hits:
        by_item[item][at - place].append((place, at, n))
    out = []
    for item, diagonals in sorted(by_item.items()):
        tokens = block.items[item]
        windows, share = 0, 0.0
        # An alignment leads unless an earlier one has taken it in and it is too short to be enough by itself.
        order = sorted(diagonals, key=lambda d: (-len(diagonals[d]), d))
        taken: set[int] = set()
        for lead in order:
            if lead in taken and len(diagonals[lead]) + WINDOW - 1 < cover * len(tokens):
                continue
            near = [d for d in order if abs(d - lead) <= len(tokens)]
            found = aligned(tokens, written, [sorted(diagonals[d]) for d in sorted(near, key=lambda d: (d != lead, -len(diagonals[d]), d))])
            taken.update(near)
            (windows, share) = max((windows, share), found, key=lambda x: (x[1], x[0]))
        if windows and share >= cover:
            out.append((item, windows, share))
        elif any(as_written(tokens, written, sorted(found)) >= run for found in diagonals.values()):
            out.append((item, windows, share))
    return out


def aligned(tokens: list[tuple[str, str]], written: list[tuple[str, str]], alignments: list[list[tuple[int, int, int]]]) -> tuple[int, float]:
    """Windows that agree on what the item's slots hold, the first alignment's first, and the share of tokens they cover."""
    held: dict[str, str] = {}
    covered, windows = set(), 0
    for found in alignments:
        for place, at, n in found:
            slots: dict[str, str] = {}
            for k in range(n):
                if tokens[place + k][0][0] == "<" and slots.setdefault(tokens[place + k][1], written[at + k][1]) != written[at + k][1]:
                    break
            else:
                if all(held.get(a, b) == b for a, b in slots.items()):
                    held.update(slots)
                    covered.update(range(place, place + n))
                    windows += 1
    return windows, len(covered) / len(tokens)


def as_written(tokens: list[tuple[str, str]], written: list[tuple[str, str]], found: list[tuple[int, int, int]]) -> int:
    """The longest run of tokens of one alignment that stand in the document as written, but for case."""
    best = size = 0
    end = -1
    for place, at, n in found:
        if place > end:
            size, end = 0, place
        for k in range(end - place, n):
            size = size + 1 if tokens[place + k][1].lower() == written[at + k][1].lower() else 0
            best = max(best, size)
        end = max(end, place + n)
    return best


def blocks(benchmark: DataFrame, size: int = BLOCK) -> Iterator[Block]:
    """The index in blocks of about ``size`` windows; items with the same text are one, under their smallest id."""
    prepare(benchmark.sparkSession)
    items = benchmark.filter("text IS NOT NULL").groupBy("text").agg(F.coalesce(F.min("item_id"), F.lit(-1)).alias("item_id"))
    counted = materialise(items, "benchmark-items")
    words = counted.agg(F.sum(F.length("text") / 4).alias("n")).first()["n"] or 0  # windows, roughly; one row
    n = max(1, int(np.ceil(words / size)))
    for k in range(n):
        rows = counted.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == k).collect()  # about `size` windows
        windows = [(i, *w) for i, r in enumerate(rows) for w in item_windows(i, r["text"])]
        if windows:
            block = Block(windows, {i: canonical(r["text"]) for i, r in enumerate(rows)})
            block.names = [r["item_id"] for r in rows]
            yield block


def contamination(docs: DataFrame, benchmark: DataFrame, cover: float = COVER, block: int = BLOCK) -> DataFrame:
    """``doc_id, contaminated, n_items, item_ids, n_windows, coverage`` of the contaminated documents.

    One row per id; ``item_ids`` is sorted, ``n_windows`` and ``coverage`` are those of the best item. Null and empty
    texts match nothing, nor do items of fewer than three tokens; a null item id is reported as -1. An empty benchmark
    gives no rows. Columns other than doc_id, item_id and text are not looked at.
    """
    spark = prepare(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("windows", pa.int64()), ("share", pa.float64())])
    found = spark.createDataFrame([], "doc_id long, item_id long, windows long, share double")
    for part in blocks(benchmark, block):
        shared = spark.sparkContext.broadcast(part)

        def search(chunks: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            yield from batches(
                (
                    (doc_id, index.names[item], windows, share)
                    for chunk in chunks
                    for doc_id, text in zip(chunk.column(0).to_pylist(), chunk.column(1))
                    for item, windows, share in matches(text.as_py(), index, cover)
                ),
                schema,
            )

        rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(search, "doc_id long, item_id long, windows long, share double")
        found = found.unionByName(rows)
    best = F.max(F.struct("share", "windows"))
    return found.groupBy("doc_id").agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"), best.alias("best")
    ).select(
        "doc_id", F.lit(True).alias("contaminated"), F.size("item_ids").cast("long").alias("n_items"), "item_ids",
        F.col("best.windows").alias("n_windows"), F.col("best.share").alias("coverage"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, cover: float = COVER, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with their columns; rows are judged one by one, nothing is moved."""
    for part in blocks(benchmark, block):
        docs = docs.filter(_clean(docs.sparkSession.sparkContext.broadcast(part), cover)("text"))
    return docs


def _clean(shared: Broadcast, cover: float):
    @F.pandas_udf("boolean")
    def clean(text: pd.Series) -> pd.Series:
        return pd.Series([not matches(t, shared.value, cover) for t in text], dtype=bool)

    return clean
