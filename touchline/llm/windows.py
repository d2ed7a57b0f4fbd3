"""Words of a batch of texts as numbers, and windows of words that stand in a text more than once."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from touchline.llm.common import words

SLICE_BYTES = 4_000_000  # text that a task holds as words at a time; one text is never split

_ODD = [pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64) for k in range(64)]


def slices(batches: Iterator[pa.RecordBatch], most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches with a ``text`` column, cut so that a piece has about ``most`` bytes of text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index("text"))), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + most, "right")))
            yield batch.slice(first, last - first)
            first = last


class Coded:
    """The words of some texts; ``codes`` numbers them (equal words, equal numbers), text k has those from ``starts[k]`` on."""

    def __init__(self, texts: list[str | None]):
        self.words = [words(t) for t in texts]
        self.sizes = np.array([len(w) for w in self.words], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        number = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(self.words)))}
        self.codes = np.fromiter(map(number.__getitem__, chain.from_iterable(self.words)), np.int64, int(self.starts[-1]))

    def repeats(self, length: int) -> np.ndarray:
        """For every word the distance from the window of ``length`` words that starts there to the nearest equal window of
        the same text; 0 where there is no equal window or no whole one. Windows are compared by 64-bit hashes."""
        n = len(self.codes)
        near = np.zeros(n, np.int64)
        text = np.repeat(np.arange(len(self.sizes)), self.sizes)
        at = np.flatnonzero(np.arange(n) + length <= self.starts[1:][text]) if n else np.empty(0, np.int64)
        if len(at) < 2:
            return near
        ids = mix(self.codes.astype(np.uint64) + np.uint64(1))
        hashes = mix((text[at] + 1).astype(np.uint64))  # windows of different texts never meet
        for k in range(length):
            hashes = hashes + ids[at + k] * np.uint64(_ODD[k])
        hashes = mix(hashes)
        order = np.argsort(hashes, kind="stable")
        place, equal = at[order], hashes[order][1:] == hashes[order][:-1]
        gap = np.where(equal, np.diff(place), np.iinfo(np.int64).max)
        least = np.minimum(np.append(gap, np.iinfo(np.int64).max), np.insert(gap, 0, np.iinfo(np.int64).max))
        near[place] = np.where(least == np.iinfo(np.int64).max, 0, least)
        return near


def covered(n: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie in a stretch ``[first, last)``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, last, -1)
    return np.cumsum(edge[:-1]) > 0


def mix(x: np.ndarray) -> np.ndarray:
    """64 bits of which each depends on all bits of ``x``."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA24BAED4963EE407)
    return x ^ (x >> np.uint64(32))
