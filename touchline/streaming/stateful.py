"""Keyed state: press triggers as they happen and a sliding request limit.

State is kept by key and second (or minute) in the state store, so a batch rewrites what it touches and nothing else; timers
forget what the watermark has passed. A key's rows are read as an iterator of Arrow batches, so a hot key is never one frame.
The state store has to be RocksDB, which :func:`touchline.session.tune` chooses.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from touchline.operators.sequences import MIN_ACTIONS, PRESS_TYPES, PRESS_WINDOW_SEC, RECOVERY


class PressTriggers(StatefulProcessor):
    """Per (match, team): what each second still within reach of a new row holds.

    A second's entry has its number of actions, the ids of those not emitted yet, and whether a ball was won in it. Entries go
    when the watermark, or the key's own last second less the delay, is past them by the window: no row that is on time can
    pair with them. While there are entries there is one timer.
    """

    def __init__(self, window: int, min_actions: int, delay: int):
        self.window, self.min_actions, self.delay = window, min_actions, delay

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seconds = handle.getMapState("seconds", "sec bigint", "actions bigint, waiting array<string>, recovered boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        stored = {k[0]: [v[0], list(v[1]), v[2]] for k, v in self.seconds.iterator()}
        held, touched = dict(stored), set()
        for batch in rows:
            for sec, event_id, recovery in zip(batch["sec"].tolist(), batch["event_id"].tolist(), batch["recovery"].tolist()):
                entry = held.setdefault(sec, [0, [], False])
                touched.add(sec)
                if recovery:
                    entry[2] = True
                else:
                    entry[0] += 1
                    entry[1].append(event_id)
        found: list[str] = []
        won = {s for s, entry in held.items() if entry[2]}
        for begin in sorted({s - d for s in touched for d in range(self.window + 1)} & won):
            inside = [s for s in range(begin, begin + self.window + 1) if s in held]
            if sum(held[s][0] for s in inside) >= self.min_actions:
                for s in inside:
                    if held[s][1]:
                        found += held[s][1]
                        held[s][1] = []
                        touched.add(s)
        horizon = max(timerValues.getCurrentWatermarkInMs() // 1000, max(held) - self.delay) - self.window
        for s, entry in held.items():
            if s < horizon and s in stored:
                self.seconds.removeKey((s,))
            elif s >= horizon and s in touched:
                self.seconds.updateValue((s,), tuple(entry))
        if not stored:  # else there is a timer
            self.wake(max(held), timerValues)
        if found:
            yield pd.DataFrame({"match_id": key[0], "team_id": key[1], "event_id": found})

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = [k[0] for k in self.seconds.keys()]
        horizon = timerValues.getCurrentWatermarkInMs() // 1000 - self.window
        if all(s < horizon for s in held):
            self.seconds.clear()
        else:
            for s in held:
                if s < horizon:
                    self.seconds.removeKey((s,))
            self.wake(max(held), timerValues)
        return iter([])

    def wake(self, last: int, timerValues) -> None:
        """A timer for when the last second can go."""
        self.handle.registerTimer(max((last + self.window + 1) * 1000, timerValues.getCurrentWatermarkInMs() + 1000))

    def close(self) -> None:
        pass


def _seconds(rows: DataFrame, interval: str) -> int:
    return rows.sparkSession.sql(f"SELECT unix_seconds(timestamp_seconds(0) + INTERVAL {interval})").first()[0]


def stream_press_triggers(
    events: DataFrame, event_time: str = "event_time", delay: str = "10 seconds", window: int = PRESS_WINDOW_SEC,
    min_actions: int = MIN_ACTIONS,
) -> DataFrame:
    """Ids of press-trigger actions, each emitted once, as soon as its window has enough actions.

    The state of a (match, team) holds the seconds a new row can still pair with: those no older than the
    watermark less the window. Rows later than the watermark are dropped, so the result equals the batch answer
    for rows that arrive on time, in whatever order.
    """
    c = F.col
    used = c("event_type").isin(*PRESS_TYPES, RECOVERY) & c("team_id").isNotNull() & c("match_id").isNotNull()
    rows = events.withWatermark(event_time, delay).where(used).select(
        "match_id", "team_id", "event_id", event_time, F.unix_timestamp(event_time).alias("sec"),
        (c("event_type") == RECOVERY).alias("recovery"),
    )
    return rows.groupBy("match_id", "team_id").transformWithStateInPandas(
        PressTriggers(window, min_actions, _seconds(events, delay)), "match_id int, team_id int, event_id string", "append", "eventTime"
    )


def accept(times: np.ndarray, accepted: deque, limit: int, window_us: int) -> np.ndarray:
    """Sliding limit over ascending microsecond times; only accepted requests count against it."""
    out = np.zeros(len(times), dtype=bool)
    for i, now in enumerate(times.tolist()):
        while accepted and accepted[0] < now - window_us:
            accepted.popleft()
        if len(accepted) < limit:
            accepted.append(now)
            out[i] = True
    return out


class RequestLimit(StatefulProcessor):
    """Per key: the accepted times that still count, at most ``limit``, and during a batch the rows that wait for their turn.

    A key with one Arrow batch is judged at once. Rows of a key with more are put into the state by slots of time first
    and judged slot by slot, in order, so that a task holds one slot of a key however many rows the key has.
    """

    def __init__(self, limit: int, window_us: int):
        self.limit, self.window_us = limit, window_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.accepted = handle.getValueState("accepted", "times array<bigint>")
        self.waiting = handle.getMapState("waiting", "slot bigint", "us array<bigint>, ids array<string>")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.accepted.get()
        accepted = deque(known[0] if known else [])
        first, second = next(rows, None), next(rows, None)
        if second is None:
            slots = iter([first])
        else:
            self.put(first)
            self.put(second)
            for more in rows:
                self.put(more)
            slots = self.taken()
        latest = None
        for slot in slots:
            ordered = slot.sort_values(["us", "request_id"], kind="stable")
            times = ordered["us"].to_numpy("int64")
            latest = int(times[-1])
            yield pd.DataFrame({
                "key": key[0], "request_id": ordered["request_id"], "us": times,
                "accepted": accept(times, accepted, self.limit, self.window_us),
            })
        self.accepted.update((list(accepted),))
        if known is None:  # else there is a timer
            self.wake(max(accepted, default=latest), timerValues)

    def wake(self, last: int, timerValues) -> None:
        """A timer for when the request at ``last`` does not count any more."""
        self.handle.registerTimer(max((last + self.window_us) // 1000, timerValues.getCurrentWatermarkInMs()) + 1)

    def put(self, batch: pd.DataFrame) -> None:
        by: dict[int, tuple[list, list]] = defaultdict(lambda: ([], []))
        for us, request_id in zip(batch["us"].tolist(), batch["request_id"].tolist()):
            times, ids = by[us // self.window_us]
            times.append(us)
            ids.append(request_id)
        for slot, (times, ids) in by.items():
            if self.waiting.containsKey((slot,)):
                before = self.waiting.getValue((slot,))
                times, ids = [*before[0], *times], [*before[1], *ids]
            self.waiting.updateValue((slot,), (times, ids))

    def taken(self) -> Iterator[pd.DataFrame]:
        for slot in sorted(k[0] for k in self.waiting.keys()):
            times, ids = self.waiting.getValue((slot,))
            self.waiting.removeKey((slot,))
            yield pd.DataFrame({"us": list(times), "request_id": list(ids)})

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Forget the key if the watermark has passed its last accepted request by the window: none counts any more."""
        known = self.accepted.get()
        last = max(known[0], default=None) if known else None
        if last is not None and (last + self.window_us) // 1000 >= timerValues.getCurrentWatermarkInMs():
            self.wake(last, timerValues)
        else:
            self.accepted.clear()
        return iter([])

    def close(self) -> None:
        pass


def stream_request_limit(requests: DataFrame, key: str, request_id: str, ts: str, limit: int = 60, window: int = 60, delay: str = "1 minute") -> DataFrame:
    """Whether each request is let through. The state of a key is its at most ``limit`` accepted times.

    Requests are judged in the batch they arrive in, by time, then id. A key is forgotten when the watermark has passed its
    last accepted request by the window. Requests later than the watermark are dropped.
    """
    at = F.col(ts).cast("timestamp")
    rows = requests.select(
        F.col(key).cast("string").alias("key"), F.col(request_id).cast("string").alias("request_id"),
        F.unix_micros(at).alias("us"), at.alias("_at"),
    ).withWatermark("_at", delay)
    return rows.groupBy("key").transformWithStateInPandas(
        RequestLimit(limit, window * 1_000_000), "key string, request_id string, us bigint, accepted boolean", "append", "eventTime"
    )
