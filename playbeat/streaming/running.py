"""Session metrics as one stateful stream: totals, breakdown and dominant label together, in ``update`` mode.

A session's state is its totals and a map from label to bytes, whatever the labels are; a micro-batch gives the row of
every session that it touched, equal to the batch result over all heartbeats so far. The state of a session stays as
long as the query; `streaming.sessions` has the form for tables and for streams without an end. Sessions are dealt to
buckets, and a call of the processor serves one bucket: what a call costs is then shared by many sessions, and a touched
session costs reading and writing its one entry. A bucket's heartbeats of one micro-batch go through one task, in Arrow
batches, of which none is kept; the sessions that they touch are.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from playbeat.functions import scalars as S
from playbeat.operators.sessions import project_flat
from playbeat.plans.partials import PARTIAL, finalize
from playbeat.schema import HEARTBEAT_INTERVAL_MS, KEYS
from playbeat.streaming.visits import ROCKSDB

# what runs in Python workers is in this module alone and travels with its code
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LONG_MAX = 2**63 - 1
SUMMED = ("bufferings", "buffering_ms", "source_bytes", "p2p_bytes")
#: Sums are null once they do not fit; ends are (server, agent) and, for the date, days since 1970 of the first.
TOTALS = [
    T.StructField(c, T.LongType())
    for c in ("n", *SUMMED, "first_server", "first_agent", "last_server", "last_agent", "day_server", "day")
]
SESSION = T.StructType([T.StructField(k, T.StringType()) for k in KEYS])
STATE = T.StructType([*TOTALS, T.StructField("labels", T.MapType(T.StringType(), T.LongType()))])
ROW = [*KEYS, "server", "agent", *SUMMED, "day", "entries"]
#: Number of buckets; a query's checkpoint belongs to it. Rows of sessions given at once.
BUCKETS, GIVEN = 1024, 5_000
RUNNING = T.StructType([T.StructField("day", T.LongType()) if f.name == "eventDate" else f for f in PARTIAL.fields])


def fitting(total: int | None, more: int) -> int | None:
    """The sum, null where it does not fit a long and from then on."""
    return None if total is None or not -LONG_MAX - 1 <= total + more <= LONG_MAX else total + more


class Running:
    """What is known of one session."""

    def __init__(self, held: tuple | None):
        n, *rest = held if held is not None else (0,) * 5 + (None,) * 6 + ({},)
        self.n, self.sums = n, list(rest[:4])
        self.first, self.last, self.day = (tuple(rest[i : i + 2]) if rest[i] is not None else None for i in (4, 6, 8))
        self.labels, self.found = dict(rest[10]), {}

    def add(self, server: int, agent: int, more: tuple, day: float | None, entries) -> None:
        self.n += 1
        self.sums = [fitting(total, x) for total, x in zip(self.sums, more)]
        end = (server, agent)
        self.first = end if self.first is None else min(self.first, end)
        self.last = end if self.last is None else max(self.last, end)
        if day is not None and day == day:
            own = (server, int(day))
            self.day = own if self.day is None else min(self.day, own)
        for e in entries if entries is not None else ():
            self.found[e["label"]] = self.found.get(e["label"], 0) + e["label_bytes"]

    def state(self) -> tuple:
        for label, more in self.found.items():
            before = self.labels.get(label, 0)
            total = fitting(before, more)
            self.labels[label] = LONG_MAX if total is None or before == LONG_MAX else total
        self.found = {}
        return (self.n, *self.sums, *self.first, *self.last, *(self.day or (None, None)), self.labels)

    def row(self, session: tuple) -> tuple:
        events, stalled, source, p2p = self.sums
        received = None if source is None or p2p is None else fitting(source, p2p)
        return (*session, self.day[1] if self.day else None, self.n, events, stalled, received, p2p, *self.first, *self.last, self.labels)


class RunningSessions(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sessions = handle.getMapState("sessions", SESSION, STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        touched: dict[tuple, Running] = {}
        for part in rows:
            for customer, content, client, server, agent, *more, day, entries in zip(*(part[c].tolist() for c in ROW)):
                session = (customer, content, client)
                if session not in touched:
                    known = self.sessions.containsKey(session)
                    touched[session] = Running(self.sessions.getValue(session) if known else None)
                touched[session].add(server, agent, more, day, entries)
        sessions = list(touched)
        for at in range(0, len(sessions), GIVEN):
            given = []
            for session in sessions[at : at + GIVEN]:
                own = touched.pop(session)
                self.sessions.updateValue(session, own.state())
                given.append(own.row(session))
            frame = pd.DataFrame(given, columns=RUNNING.fieldNames(), dtype=object)
            yield frame.astype({f.name: "Int64" for f in RUNNING.fields if isinstance(f.dataType, T.LongType)})

    def close(self) -> None:
        pass


def running_metrics(stream: DataFrame, heartbeat_interval_ms: int = HEARTBEAT_INTERVAL_MS, min_snapshots: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """Rows of the session metrics, all columns, for ``update`` output: the last one of a session is its metrics.

    The number of buckets belongs to the checkpoint: a query goes on with the one that it was started with.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    entries = f"transform(map_entries(qualityDistribution), e -> struct(e.key as label, {S.received_bytes('e.value')} as label_bytes))"
    rows = project_flat(stream, f"{entries} as entries")
    rows = rows.selectExpr(
        *KEYS, "server", "agent", *SUMMED, "cast(unix_date(eventDate) as bigint) as day", "entries",
        f"cast(pmod(xxhash64({', '.join(KEYS)}), {buckets}) as int) as bucket",
    )
    states = rows.groupBy("bucket").transformWithStateInPandas(RunningSessions(), RUNNING, "Update", "None")
    dated = states.selectExpr(*["date_from_unix_date(cast(day as int)) as eventDate" if c == "eventDate" else c for c in PARTIAL.fieldNames()])
    return finalize(dated, heartbeat_interval_ms, min_snapshots)
