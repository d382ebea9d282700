"""Windows by visit, batch and stream, against a plain loop."""

import random
from collections import defaultdict
from types import SimpleNamespace

import pandas as pd
import pytest
from beats import T0, expected_heartbeats

from playbeat.operators.visits import visit_heartbeats
from playbeat.schema import HEARTBEAT, PLAYER_EVENT
from playbeat.streaming.visits import OWN, VisitProcessor, Visits, start_visit_stream

GAP = 120_000
KINDS = ["waiting", "stalled", "playing", "level", "frag", "frag_loading", "frag_loaded", "other"]


def talk(seed, viewers=4, visits=5, events=40):
    """(client, t, event, height, level, size): visits with pauses, some with start or stop."""
    r, out = random.Random(seed), []
    for v in range(viewers):
        t = T0 + r.randint(0, 50_000)
        out.append((f"v{v}", t - 10, "waiting", None, None, 0))
        out += [(f"v{v}", t - 5, "start", None, None, 0)] * (v % 2)
        for _ in range(visits):
            if r.random() < 0.4:
                out.append((f"v{v}", t, "start", None, None, 0))
            for _ in range(r.randint(1, events)):
                out.append((f"v{v}", t, r.choice(KINDS), r.choice([None, 0, 720, 1080]), r.choice([None, 2, 3]), r.randint(0, 99)))
                t += r.choice([0, 1, 700, 9_000, 30_000, 61_000, GAP])
            if r.random() < 0.5:
                out.append((f"v{v}", t, "stop", None, None, 0))
                t += r.choice([1, 5_000])
            else:
                t += GAP + r.choice([1, 10**6])
    return out


def expected(rows, clip=False, interval=30_000):
    """{(client, end): (bufferings, ms, labels)} of all windows, quiet ones too."""
    viewers = defaultdict(list)
    for client, *event in rows:
        viewers[client].append(tuple(event))
    out = {}
    for client, events in viewers.items():
        events = [e for _, e in sorted(enumerate(events), key=lambda x: (x[1][0], x[0]))]
        times = sorted({e[0] for e in events})
        has = lambda t, kind: any(e[0] == t and e[1] == kind for e in events)
        cuts = [t for i, t in enumerate(times) if i == 0 or t - times[i - 1] > GAP or has(times[i - 1], "stop") or has(t, "start")]
        for first, after in zip(cuts, [*cuts[1:], float("inf")]):
            visit = [e for e in events if first <= e[0] < after]
            last = max(e[0] for e in visit)
            wins = expected_heartbeats(visit, interval, first)
            for win in range((last - first) // interval + 1):
                n, ms, labels = wins.get(win, (0, 0, {}))
                end = first + (win + 1) * interval
                if clip and win == (last - first) // interval:
                    ms -= (end - min(end, last)) if still_open(visit, first, win, interval) else 0
                    end = min(end, last)
                out[client, end] = (n, ms, labels)
    return out


def still_open(visit, first, win, interval):
    state = None
    for t, event, *_ in visit:
        if (t - first) // interval == win:
            state = 1 if event in ("waiting", "stalled") else 0 if event == "playing" else state
    return state == 1


def frame(spark, rows):
    full = [("c", "w", client, t, i, event, height, level, size, size, i) for i, (client, t, event, height, level, size) in enumerate(rows)]
    return spark.createDataFrame(full, PLAYER_EVENT)


def windows(df):
    out = {}
    for r in df.collect():
        key = (r.clientId, r.timestampInfo.agent)
        assert key not in out
        out[key] = (r.player.bufferings, r.player.bufferingTime, {k: (d.sourceTraffic.requests, d.sourceTraffic.receivedData) for k, d in r.qualityDistribution.items()})
    return out


@pytest.mark.parametrize("clip", [False, True])
def test_batch(spark, clip):
    rows = talk(1)
    assert windows(visit_heartbeats(frame(spark, rows), clip_last=clip, visit_gap_ms=GAP)) == expected(rows, clip)


def test_visits_days_apart_are_two_sets_of_windows(spark):
    day = 86_400_000
    rows = [("v", T0 + 7, "other", None, None, 0), ("v", T0 + 40_000, "waiting", None, None, 0), ("v", T0 + 3 * day + 11, "playing", None, None, 0)]
    got = windows(visit_heartbeats(frame(spark, rows)))
    assert got == {("v", T0 + 30_007): (0, 0, {}), ("v", T0 + 60_007): (1, 20_007, {}), ("v", T0 + 3 * day + 30_011): (0, 0, {})}


@pytest.mark.parametrize("clip", [False, True])
def test_state_machine_step_by_step(clip):
    """However often time is looked at, windows are the same, and nothing stays once the last visit is over."""
    for seed in range(30):
        rows = [(t, i, event) for i, (_, t, event, *_) in enumerate(talk(seed, viewers=1))]
        machine = Visits(30_000, GAP, clip)
        want = {(start, end, e) for e, start, end in machine.advance(None, rows, 10**14)[0]}
        assert {r[1] for r in want} == {k[1] for k in expected([("v", t, e, None, None, 0) for t, _, e in rows], clip)}
        r = random.Random(seed)
        arrivals = sorted(rows, key=lambda e: e[0] + r.randint(0, 50_000))
        place, held, got, until, again, at = None, [], [], 0, None, 0
        while at < len(arrivals) or held:
            n = r.randint(1, 9)
            held, at = held + arrivals[at : at + n], at + n
            left = min((e[0] for e in arrivals[at:]), default=None)
            until = max(until, left - 1 if left is not None else until + r.choice([1, 10_000, 40_000, GAP]))
            out, place, held, again = machine.advance(place, held, until)
            got += out
        assert len(got) == len(want) and {(start, end, e) for e, start, end in got} == want
        out, place, held, again = machine.advance(place, held, until + GAP + 10**6)
        assert (out, place, held, again) == ([], None, [], None)


@pytest.mark.parametrize("clip", [False, True])
def test_stream_with_a_restart(spark, tmp_path, clip):
    """Random batches in random order with a restart between; at last time moves on and the state is empty."""
    paths = {k: str(tmp_path / k) for k in ("in", "out", "check")}
    rows = talk(7)
    order = sorted(range(len(rows)), key=lambda i: rows[i][1] + random.Random(i).randint(0, 200_000))
    far = frame(spark, [("~", rows[-1][1] + 10**9, "other", None, None, 0)])
    df = {r.event_id: r for r in frame(spark, rows).collect()}

    def write(ids):
        spark.createDataFrame([df[i] for i in ids], PLAYER_EVENT).coalesce(1).write.mode("append").parquet(paths["in"])

    def run():
        events = spark.readStream.schema(PLAYER_EVENT).option("maxFilesPerTrigger", "1").parquet(paths["in"])
        query = start_visit_stream(events, paths["out"], paths["check"], "200 seconds", None, visit_gap_ms=GAP, clip_last=clip)
        query.awaitTermination()
        return query.lastProgress

    half = len(order) // 2
    for part in (order[:half:2], order[1:half:2]):
        write(sorted(part))
    run()
    write(order[half:])
    far.coalesce(1).write.mode("append").parquet(paths["in"])
    progress = run()
    assert windows(spark.read.schema(HEARTBEAT).parquet(paths["out"])) == expected(rows, clip)
    assert progress.stateOperators[0].numRowsTotal <= 3  # those of the last, lone event


class Values(list):
    """A list state or value state, and how often it was asked."""

    calls = 0

    def appendList(self, rows):
        self.calls += 1
        self.extend(rows)

    def get(self):
        self.calls += 1
        return list(self) if self.many else (tuple(self) or None)

    def update(self, value):
        self[:] = value


def test_one_call_and_one_timer_serve_many_viewers():
    states, timers = {}, []

    def state(name, _, many):
        states[name] = Values()
        states[name].many = many
        return states[name]

    handle = SimpleNamespace(
        getListState=lambda name, kind: state(name, kind, True), getValueState=lambda name, kind: state(name, kind, False),
        registerTimer=timers.append, deleteTimer=timers.remove,
    )
    processor = VisitProcessor(30_000, GAP, False)
    processor.init(handle)
    rows = [("c", "w", client, t, i, event, height, level, size, size, i) for i, (client, t, event, height, level, size) in enumerate(talk(3, viewers=25))]
    frame = pd.DataFrame(rows, columns=["customerId", "contentId", "clientId", *OWN.fieldNames()])
    now = lambda ms: SimpleNamespace(getCurrentWatermarkInMs=lambda: ms)
    assert list(processor.handleInputRows((1,), iter([frame]), now(0))) == []
    assert timers == [frame["t"].min() + 29_999] and states["events"].calls == 1
    timers.clear()  # as it has expired
    given = pd.concat(processor.handleExpiredTimer((1,), now(10**14), None))
    wanted = expected([(client, t, event, height, level, size) for _, _, client, t, _, event, height, level, size, *_ in rows])
    assert set(zip(given["clientId"], given["win_end"])) == set(wanted)
    assert sum(s.calls for s in states.values()) < 10 and not any(states.values()) and not timers
