"""Heartbeats of visits from a stream of player events, in keyed state with timers.

A viewer's state holds the events of windows that may still grow and where the last finished window stood. When the
watermark has passed a window's end, its events leave the state together, with the windows of the visit that were
quiet before it; the batch operators make heartbeats of them. When the watermark is more than the visit gap past the
last event, the state is dropped. Viewers are dealt to buckets: state, timer and calls of the processor are a bucket's,
so that what a call costs is shared by many viewers. The result is that of `operators.visits.visit_heartbeats`, provided
that no event is later than the watermark allows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from playbeat.operators.player_events import CHUNK_MS, VISIT_GAP_MS, _keyed, to_heartbeats, window_totals
from playbeat.schema import HEARTBEAT_INTERVAL_MS, KEYS, PLAYER_EVENT
from playbeat.session import query_id

# what runs in Python workers is in this module alone and travels with its code
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OWN = T.StructType([f for f in PLAYER_EVENT.fields if f.name not in KEYS])
WINDOWED = T.StructType([*PLAYER_EVENT.fields, *(T.StructField(c, T.LongType()) for c in ("win", "win_start", "win_end"))])
OF_KEYS = [T.StructField(k, T.StringType()) for k in KEYS]
#: An event of a viewer that waits for its window's end.
HELD = T.StructType([*OF_KEYS, *OWN.fields])
#: Where a viewer stands: start of the visit, number of its last finished window, time of its last event in a
#: finished window, and whether that was a stop.
PLACE = T.StructType([*OF_KEYS, *(T.StructField(c, T.LongType()) for c in ("visit", "done", "last_t", "stopped"))])
TIMER = T.StructType([T.StructField("timer", T.LongType())])
#: Number of buckets; a stream's checkpoint belongs to it. Rows given at once.
BUCKETS, GIVEN = 1024, 10_000


class Visits:
    """Cuts a viewer's events into windows as time goes on; a plain state machine over (t, event_id, event, ...)."""

    def __init__(self, interval: int, gap: int, clip: bool):
        self.interval, self.gap, self.clip = interval, gap, clip

    def advance(self, place: tuple | None, events: list[tuple], until: int) -> tuple[list[tuple], tuple | None, list[tuple], int | None]:
        """Rows of the windows that are complete when all events up to `until` are in, the new place, the events that
        stay, and when to look again. A row is (event or None, start, end)."""
        visit, done, last, stopped = place or (None, None, None, 0)
        events = sorted(events, key=lambda e: (e[0], e[1] is not None, e[1]))
        starts, stops = {e[0] for e in events if e[2] == "start"}, {e[0] for e in events if e[2] == "stop"}
        out, group = [], []  # events of the window under way
        number, seen, ended = None, last, bool(stopped)

        def finish(over: bool) -> None:
            nonlocal done, last, group
            start = visit + number * self.interval
            for k in range(done + 1, number) if done is not None else ():
                out.append((None, visit + k * self.interval, visit + (k + 1) * self.interval))
            end = start + self.interval
            end = min(end, group[-1][0]) if self.clip and over else end
            out.extend((e, start, end) for e in group)
            done, last, group = number, group[-1][0], []

        at = 0
        while at < len(events) and events[at][0] <= until:
            t = events[at][0]
            anew = visit is None or t in starts and t != seen or t - seen > self.gap or ended and t != seen
            if anew:
                if group:
                    finish(True)
                visit, done, number = t, None, None
            here = (t - visit) // self.interval
            if group and here != number:
                finish(False)
            number = here
            while at < len(events) and events[at][0] == t:
                group.append(events[at])
                at += 1
            seen, ended = t, t in stops
        ahead = events[at:]
        if group:
            over = ended or until - seen > self.gap
            if over or not self.clip and visit + (number + 1) * self.interval - 1 <= until:
                finish(over)
        if not group and visit is not None and (ended or until - seen > self.gap):
            visit = None  # whatever comes begins a visit
        waits = [ahead[0][0] + (0 if group and self.clip else self.interval - 1)] if ahead else []
        if group:
            waits.append(seen + self.gap + 1 if self.clip else visit + (number + 1) * self.interval - 1)
        elif visit is not None:
            waits.append(seen + self.gap + 1)
        # a visit none of whose windows is finished begins anew with the events that stay
        now = None if visit is None or done is None else (visit, done, last, int(ended and not group))
        return out, now, group + ahead, max(min(waits), until + 1) if waits else None


class VisitProcessor(StatefulProcessor):
    """The viewers of a bucket: their waiting events, where they stand, and one timer for the first that is due."""

    def __init__(self, interval: int, gap: int, clip: bool):
        self.visits = Visits(interval, gap, clip)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.events = handle.getListState("events", HELD)
        self.places = handle.getListState("places", PLACE)
        self.timer = handle.getValueState("timer", TIMER)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names, earliest = HELD.fieldNames(), None
        for part in rows:
            columns = [part[f.name].tolist() for f in HELD.fields]
            for at, f in enumerate(HELD.fields):
                whole = isinstance(f.dataType, (T.LongType, T.IntegerType))
                columns[at] = [None if pd.isna(v) else int(v) if whole else v for v in columns[at]]
            self.events.appendList(list(zip(*columns)))
            earliest = min(columns[names.index("t")] + ([] if earliest is None else [earliest]))
        held = self.timer.get()
        self._wake(held[0] if held else None, earliest + self.visits.interval - 1, timerValues.getCurrentWatermarkInMs(), False)
        return iter([])

    def _wake(self, timer: int | None, wanted: int | None, now: int, replace: bool) -> None:
        """Sets the one timer, to `wanted` or, without `replace`, to the earlier of both."""
        wanted = None if wanted is None else max(wanted, now + 1)
        if not replace and timer is not None:
            wanted = min(timer, wanted)
        if wanted == timer:
            return
        if timer is not None and timer > now:
            self.handle.deleteTimer(timer)
        if wanted is None:
            self.timer.clear()
        else:
            self.handle.registerTimer(wanted)
            self.timer.update((wanted,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until, k = timerValues.getCurrentWatermarkInMs(), len(KEYS)
        viewers: dict[tuple, tuple[tuple | None, list[tuple]]] = {tuple(p[:k]): (tuple(p[k:]), []) for p in self.places.get()}
        n = 0
        for n, event in enumerate(self.events.get(), 1):
            viewers.setdefault(tuple(event[:k]), (None, []))[1].append(tuple(event[k:]))
        empty = (None,) * (len(OWN.fieldNames()) - 1)
        places, stay, due, given = [], [], [], []
        for viewer, (place, held) in viewers.items():
            out, now, ahead, again = self.visits.advance(place, held, until)
            places += [(*viewer, *now)] if now is not None else []
            stay += [(*viewer, *e) for e in ahead]
            due += [again] if again is not None else []
            given += [(*viewer, *(e if e is not None else (start, *empty)), start, start, end) for e, start, end in out]
        if len(stay) != n:
            self._replace(self.events, stay)
        self._replace(self.places, places)
        timer = self.timer.get()
        self._wake(timer[0] if timer else None, min(due, default=None), until, True)
        kinds = {f.name: "Int64" for f in WINDOWED.fields if not isinstance(f.dataType, T.StringType)}
        for at in range(0, len(given), GIVEN):
            yield pd.DataFrame(given[at : at + GIVEN], columns=WINDOWED.fieldNames(), dtype=object).astype(kinds)

    @staticmethod
    def _replace(state, rows: list[tuple]) -> None:
        state.clear()
        for at in range(0, len(rows), GIVEN):
            state.appendList(rows[at : at + GIVEN])

    def close(self) -> None:
        pass


def windowed_stream(
    events: DataFrame, watermark: str, interval_ms: int = HEARTBEAT_INTERVAL_MS, visit_gap_ms: int = VISIT_GAP_MS, clip_last: bool = False,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Finished windows of a stream of player events: all events of a window in one micro-batch, quiet ones as a bare row.

    The number of buckets belongs to the checkpoint: a stream goes on with the one that it was started with.
    """
    timed = _keyed(events).withColumn("event_time", F.timestamp_millis("t")).withWatermark("event_time", watermark)
    timed = timed.withColumn("bucket", F.expr(f"cast(pmod(xxhash64({', '.join(KEYS)}), {buckets}) as int)"))
    processor = VisitProcessor(interval_ms, visit_gap_ms, clip_last)
    return timed.groupBy("bucket").transformWithStateInPandas(processor, WINDOWED, "Append", "EventTime")


def start_visit_stream(
    events: DataFrame,
    output_path: str,
    checkpoint_path: str,
    watermark: str = "1 minute",
    trigger_interval: str | None = "30 seconds",
    interval_ms: int = HEARTBEAT_INTERVAL_MS,
    visit_gap_ms: int = VISIT_GAP_MS,
    clip_last: bool = False,
    chunk_ms: int = CHUNK_MS,
) -> StreamingQuery:
    """Player events to a heartbeat table, ``<output>/part=<query>-<batch>/eventDate=D``.

    A micro-batch that is replayed replaces its own part; a batch without finished windows writes none. Events later
    than the watermark are not counted. One bucket's open windows are in one task's state.
    """
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    windowed = windowed_stream(events, watermark, interval_ms, visit_gap_ms, clip_last)

    def store(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                beats = to_heartbeats(window_totals(batch, chunk_ms))
                path = f"{output_path}/part={query_id(batch.sparkSession, checkpoint_path)}-{batch_id}"
                beats.hint("rebalance", "eventDate").write.mode("overwrite").partitionBy("eventDate").parquet(path)
        finally:
            batch.unpersist()

    writer = windowed.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint_path)
    if trigger_interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger_interval).start()
