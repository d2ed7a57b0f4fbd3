"""The keyed processors by themselves: order of rows, many Arrow batches of one key, bounded state, late rows."""

from __future__ import annotations

import json
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_tables import sequential_limit

from touchline.streaming import ingest, stateful


class Store:
    """The state of one key, in memory, with the calls that the processors make; counts what is written."""

    def __init__(self):
        self.values, self.timers, self.written, self.most = {}, set(), 0, 0

    def getMapState(self, *_):
        return self

    getValueState = getMapState

    def iterator(self):
        return iter(list(self.values.items()))

    def keys(self):
        return iter([k for k in self.values if k])

    def containsKey(self, key):
        return key in self.values

    def getValue(self, key):
        return self.values[key]

    def updateValue(self, key, value):
        self.values[key] = value
        self.written += 1
        self.most = max(self.most, len(self.values))

    def removeKey(self, key):
        del self.values[key]

    def get(self):
        return self.values.get(())

    def update(self, value):
        self.values[()] = value

    def clear(self):
        self.values.clear()

    def registerTimer(self, due):
        self.timers.add(due)

    def expired(self, now):
        """Whether a timer has run out; it is gone then."""
        due = {t for t in self.timers if t < now}
        self.timers -= due
        return bool(due)


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def expected(rows, window, least):
    """Actions in the window of a recovery that has enough of them."""
    out = set()
    for sec, _, recovery in rows:
        if recovery:
            inside = [i for s, i, r in rows if not r and sec <= s <= sec + window]
            if len(inside) >= least:
                out.update(inside)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_press_rows_in_any_order_within_the_delay(seed):
    rng = np.random.default_rng(seed)
    secs = np.sort(rng.integers(0, 3000, 2500))
    rows = [(int(s), f"e{i}", bool(rng.integers(4) == 0)) for i, s in enumerate(secs)]
    arrival = sorted(range(len(rows)), key=lambda i: rows[i][0] + rng.integers(0, 10))  # up to ten seconds late
    store, got, high = Store(), [], 0
    step = stateful.PressTriggers(5, 3, 10)
    step.init(store)
    for k in range(0, len(rows), 100):
        part = pd.DataFrame([rows[i] for i in arrival[k : k + 100]], columns=["sec", "event_id", "recovery"])
        clock = Clock(max(0, high - 10) * 1000)
        for out in step.handleInputRows((1, 2), iter([part[:30], part[30:]]), clock):
            got += out["event_id"].tolist()
        if store.expired(clock.ms):
            list(step.handleExpiredTimer((1, 2), clock, None))
        high = max(high, int(part["sec"].max()))
    assert len(got) == len(set(got)) and set(got) == expected(rows, 5, 3)
    # Only the seconds of the delay and the window are held, with one timer, however many rows have passed.
    assert store.most <= 2 * (10 + 5 + 1) and len(store.timers) == 1
    assert list(step.handleExpiredTimer((1, 2), Clock((high + 6) * 1000), None)) == [] and not store.values


@pytest.mark.parametrize("pieces", [1, 2, 9])
def test_request_limit_of_a_key_in_many_pieces(pieces):
    rng = np.random.default_rng(pieces)
    times = rng.permutation(rng.integers(0, 4000, 900)) * 1_000_000
    rows = pd.DataFrame({"key": "u", "request_id": [f"r{i:04d}" for i in range(900)], "us": times})
    store = Store()
    step = stateful.RequestLimit(5, 60_000_000)
    step.init(store)
    size = -(-900 // pieces)
    parts = [rows[i : i + size] for i in range(0, 900, size)]
    out = pd.concat(list(step.handleInputRows(("u",), iter(parts), Clock(0))))
    ordered = rows.sort_values(["us", "request_id"])
    assert out["request_id"].tolist() == ordered["request_id"].tolist()
    assert out["accepted"].tolist() == sequential_limit(ordered["us"].tolist(), 5, 60_000_000)
    assert list(store.values) == [()] and len(store.get()[0]) <= 5  # nothing waits after a batch
    more = pd.DataFrame({"key": "u", "request_id": ["z"], "us": [int(times.max()) + 1]})
    again = list(step.handleInputRows(("u",), iter([more]), Clock(0)))
    assert len(again) == 1 and len(store.timers) == 1
    assert list(step.handleExpiredTimer(("u",), Clock(10), None)) == [] and store.values and len(store.timers) == 1
    assert list(step.handleExpiredTimer(("u",), Clock(10**9), None)) == [] and not store.values


def test_a_limit_of_nothing():
    step = stateful.RequestLimit(0, 1)
    step.init(Store())
    rows = pd.DataFrame({"key": "u", "request_id": ["a", "b"], "us": [1, 2]})
    assert not any(next(step.handleInputRows(("u",), iter([rows]), Clock(0)))["accepted"])


def stream_of(spark, folder, batches, schema):
    folder.mkdir()
    for i, rows in enumerate(batches):
        part = folder / f"{i:03d}.json"
        part.write_text("\n".join(json.dumps(r) for r in rows))
        os.utime(part, (1_700_000_000 + i, 1_700_000_000 + i))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))


def test_late_rows_are_dropped(spark, tmp_path):
    def row(i, s):
        return {"request_id": i, "user": "u", "sec": 10_000 + s}

    batches = [[row("a", 0)], [row("b", 500)], [row("c", 501)], [row("late", 20), row("d", 502)]]
    stream = stream_of(spark, tmp_path / "in", batches, "request_id string, user string, sec long")
    timed = stream.withColumn("ts", F.timestamp_seconds("sec"))
    got = ingest.run_to_table(stateful.stream_request_limit(timed, "user", "request_id", "ts", 1, 60), "late").collect()
    assert {r["request_id"]: r["accepted"] for r in got} == {"a": True, "b": True, "c": False, "d": False}


def test_hot_key_comes_in_many_arrow_batches(spark, tmp_path):
    rng = np.random.default_rng(2)
    secs = rng.integers(0, 2000, 600).tolist()
    rows = [{"request_id": f"r{i:04d}", "user": "u", "sec": s} for i, s in enumerate(secs)]
    stream = stream_of(spark, tmp_path / "in", [rows], "request_id string, user string, sec long")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        timed = stream.withColumn("ts", F.timestamp_seconds("sec"))
        got = ingest.run_to_table(stateful.stream_request_limit(timed, "user", "request_id", "ts", 10, 60), "hot").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    ordered = sorted(rows, key=lambda r: (r["sec"], r["request_id"]))
    want = dict(zip((r["request_id"] for r in ordered), sequential_limit([r["sec"] for r in ordered], 10, 60)))
    assert {r["request_id"]: r["accepted"] for r in got} == want
