"""Heartbeats from player events: edge cases and random events against a plain loop."""

import random

import pytest
from beats import T0, events_frame, expected_heartbeats

from playbeat.operators import insights, player_events as pe
from playbeat.plans.metrics import compute_metrics
from playbeat.schema import PLAYER_EVENT
from playbeat.streaming.player import heartbeats_aligned


def ev(t, event, height=None, level=None, size=None):
    return (T0 + t, event, height, level, size)


def windows(df, first=T0, interval=30_000):
    out = {}
    for r in df.collect():
        q = {
            k: (d.sourceTraffic.requests, d.sourceTraffic.receivedData) for k, d in r.qualityDistribution.items()
        }
        out[(r.timestampInfo.agent - first) // interval - 1] = (r.player.bufferings, r.player.bufferingTime, q)
    return out


CASES = {
    "stalled_while_waiting": (
        [ev(0, "other"), ev(1000, "level", 1080, 0), ev(2000, "waiting"), ev(2500, "stalled"), ev(4000, "playing")],
        {0: (1, 2000, {})},
    ),
    "stall_over_the_boundary": (
        [ev(0, "other"), ev(29_000, "waiting"), ev(31_000, "playing")], {0: (1, 1000, {}), 1: (0, 0, {})},
    ),
    "playing_without_start": ([ev(0, "other"), ev(5000, "playing")], {0: (0, 0, {})}),
    "quiet_window": ([ev(0, "frag", size=5), ev(65_000, "playing")], {0: (0, 0, {"unknown": (1, 5)}), 1: (0, 0, {}), 2: (0, 0, {})}),
    "level_without_height": (
        [ev(0, "level", None, 3), ev(1, "frag", size=2), ev(2, "level", 0, 4), ev(3, "frag", size=3)],
        {0: (0, 0, {"level_3": (1, 2), "level_4": (1, 3)})},
    ),
    "unknown_level_keeps_label": (
        [ev(0, "level", 720, 1), ev(1, "level", None, None), ev(2, "frag", size=2)], {0: (0, 0, {"720p": (1, 2)})},
    ),
    "label_reset": (
        [ev(0, "level", 720, 1), ev(30_000, "frag", size=2)], {0: (0, 0, {}), 1: (0, 0, {"unknown": (1, 2)})},
    ),
    "request_and_load_apart": (
        [ev(0, "level", 720, 1), ev(1, "frag_loading", size=9), ev(2, "level", 360, 2), ev(3, "frag_loaded", size=9)],
        {0: (0, 0, {"720p": (1, 0), "360p": (0, 9)})},
    ),
}


@pytest.mark.parametrize("name", list(CASES))
def test_case(spark, name):
    rows, want = CASES[name]
    assert windows(pe.build_heartbeats(events_frame(spark, rows))) == want


def test_clip_last(spark):
    rows = [ev(0, "other"), ev(31_000, "waiting"), ev(35_000, "other")]
    full, clipped = (
        sorted((r.timestampInfo.agent - T0, r.player.bufferingTime) for r in
               pe.build_heartbeats(events_frame(spark, rows), clip_last=c).collect())
        for c in (False, True)
    )
    assert full == [(30_000, 0), (60_000, 29_000)]
    assert clipped == [(30_000, 0), (35_000, 4_000)]


def random_events(seed, n=600, span=200_000):
    r = random.Random(seed)
    kinds = ["waiting", "stalled", "playing", "level", "frag", "frag_loading", "frag_loaded", "other"]
    rows = [ev(0, "other")]
    for _ in range(n):
        kind = r.choice(kinds)
        rows.append(ev(
            r.randint(0, span), kind, r.choice([None, 0, 720, 1080]), r.choice([None, 2, 3]), r.randint(0, 99)
        ))
    return rows


@pytest.mark.parametrize("chunk_ms", [7, 1_000, 30_000])
def test_random_events(spark, chunk_ms):
    for seed, n in ((1, 60), (2, 900)):
        rows = random_events(seed, n)
        df = events_frame(spark, rows)
        got = windows(pe.build_heartbeats(df, quiet_windows=False, chunk_ms=chunk_ms))
        assert got == expected_heartbeats(rows)
        intervals = pe.buffer_intervals(df, chunk_ms=chunk_ms).collect()
        for win, (count, ms, _) in expected_heartbeats(rows).items():
            mine = [i for i in intervals if i.win == win]
            assert (len(mine), sum(i.duration_ms for i in mine)) == (count, ms)


def test_aligned_windows(spark):
    start = T0 // 30_000 * 30_000
    rows = random_events(5, 300)
    assert windows(heartbeats_aligned(events_frame(spark, rows)), start) == expected_heartbeats(rows, start=start)


def test_quiet_windows_within_a_visit_only(spark):
    rows = [ev(0, "other"), ev(30_000 * 60, "other"), ev(30_000 * 121, "other"), ev(86_400_000 * 9, "other")]
    got = sorted(windows(pe.build_heartbeats(events_frame(spark, rows))))
    assert got == [*range(61), 121, 86_400_000 * 9 // 30_000]
    assert pe.build_heartbeats(events_frame(spark, rows), visit_gap_ms=30_000 * 61).count() == 123


def test_a_bogus_clock_adds_one_window(spark):
    rows = [(0, "other", None, None, None), ev(0, "other")]
    assert pe.build_heartbeats(events_frame(spark, rows)).count() == 2


def test_chain_to_sessions(spark):
    rows = [ev(0, "level", 720, 1), ev(10, "frag", size=8), ev(20, "waiting"), ev(40_000, "playing")]
    r = compute_metrics(pe.build_heartbeats(events_frame(spark, rows))).first()
    assert (r.watch_time_ms, r.total_buffering_events, r.total_buffering_time_ms) == (60_000, 1, 29_980)
    assert (r.dominant_quality, r.total_received_bytes, r.p2p_ratio) == ("720p", 8, 0.0)


@pytest.mark.parametrize("chunk_ms", [50, 60_000])
def test_quality_switches(spark, chunk_ms):
    heights = [720, 1080, 1080, 360, None, 720, 270]
    rows = [ev(i * 40, "level", h, 1) for i, h in enumerate(heights)]
    r = insights.quality_switches(events_frame(spark, rows), chunk_ms).first()
    assert (r.level_events, r.upshifts, r.downshifts) == (6, 2, 2)


def test_a_hot_viewer_is_spread(spark):
    """Rows are ordered within (viewer, window, chunk), never within a viewer or a whole window."""
    plan = pe.build_heartbeats(events_frame(spark, [ev(0, "frag", size=1)]))._jdf.queryExecution().optimizedPlan()
    windows_of_rows = [x for x in plan.toString().split("\n") if "Window" in x and "event_id" in x]
    assert windows_of_rows and all("chunk" in x for x in windows_of_rows)


def test_viewer_join_can_be_split_when_skewed(spark):
    """Both inputs of the join with the viewer spans come straight from a shuffle on the viewer."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = pe.assign_windows(events_frame(spark, [ev(0, "frag", size=1)]))
        lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sorts = [i for i, x in enumerate(lines) if "Sort [" in x]
    assert len(sorts) == 2
    assert all("Exchange hashpartitioning" in lines[i + 1] and "viewer_hash" not in lines[i + 1] for i in sorts)


def test_a_load_answers_its_own_request(spark):
    """A fragment asked for at 1080p and loaded after a switch to 720p did not fail; one never loaded did."""
    from playbeat.operators.insights import segment_failures

    rows = [
        (T0, 1, "level", 1080, None), (T0 + 10, 2, "frag_loading", None, 7), (T0 + 20, 3, "level", 720, None),
        (T0 + 30, 4, "frag_loaded", None, 7), (T0 + 40, 5, "frag_loading", None, 8), (T0 + 50, 6, "frag_loading", None, None),
    ]
    full = [("c", "w", "v", t, i, event, height, None, 1, 1, segment) for t, i, event, height, segment in rows]
    got = {r.quality_label: (r.requests, r.loads, r.failures, r.failure_rate) for r in segment_failures(spark.createDataFrame(full, PLAYER_EVENT)).collect()}
    assert got == {"1080p": (1, 1, 0, 0.0), "720p": (2, 0, 2, 1.0)}


@pytest.mark.parametrize("name", ["asof_quality", "buffer_intervals", "segment_failures"])
def test_events_are_windowed_once(spark, tmp_path, name):
    """Rows and what chunks hand over come from one exchange: no more scans than windows alone need."""
    rows = random_events(3, 200)
    events_frame(spark, rows).write.parquet(str(tmp_path / "events"))
    events = spark.read.schema(PLAYER_EVENT).parquet(str(tmp_path / "events"))

    def scans(df):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        return plan.count("FileScan")

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        alone = scans(pe.assign_windows(events))
        assert scans({**vars(insights), **vars(pe)}[name](events)) == alone == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
