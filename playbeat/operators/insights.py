"""Follow-on analyses: stall position and clustering, quality switches, failures, spikes, windows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from playbeat.functions import scalars as S
from playbeat.operators.player_events import CHUNK_MS, LOADS, REQUESTS, asof_quality, buffer_intervals, viewer_spans
from playbeat.operators.sessions import SERVER, exprs, key_columns
from playbeat.schema import HEARTBEAT_INTERVAL_MS, KEYS

SPIKE_SHARE = 0.15  # fixed value: share of viewers that makes a buffering spike
SWITCH_CHUNK_MS = 60_000


def buffering_position(events: DataFrame, interval_ms: int = HEARTBEAT_INTERVAL_MS) -> DataFrame:
    """Where in the session each stall began: offset from the first event, first half or second."""
    joined = buffer_intervals(events, interval_ms).join(viewer_spans(events), on=KEYS)
    return joined.selectExpr(
        *KEYS,
        "start_ms",
        "event_id",
        "duration_ms",
        "start_ms - first_t as offset_ms",
        "if((start_ms - first_t) * 2 >= last_t - first_t, 'late', 'early') as position",
    )


def buffering_clusters(
    events: DataFrame, min_viewers: int = 2, bucket_ms: int = 1_000, interval_ms: int = HEARTBEAT_INTERVAL_MS
) -> DataFrame:
    """Seconds in which at least ``min_viewers`` viewers of one content began to stall.

    Viewers are made distinct before the content is grouped, so popular content is combined early.
    """
    bucket = ["customerId", "contentId", "bucket_ms"]
    starts = buffer_intervals(events, interval_ms).selectExpr("*", f"start_ms div {bucket_ms}L * {bucket_ms} as bucket_ms")
    per_viewer = starts.groupBy(*bucket, "clientId").agg(*exprs("count(1) as n"))
    counts = per_viewer.groupBy(*bucket).agg(*exprs("count(1) as viewers", "sum(n) as stalls"))
    return counts.filter(f"viewers >= {min_viewers}")


def quality_switches(events: DataFrame, chunk_ms: int = SWITCH_CHUNK_MS) -> DataFrame:
    """Up and down switches per viewer, by the height of successive level events.

    Heights are compared within time chunks, then the last height of each chunk with the first of the
    next one, so a viewer with very many events is spread over tasks.
    """
    keys = KEYS + ["chunk"]
    in_chunk = f"partition by {', '.join(keys)} order by t, event_id"
    whole = "rows between unbounded preceding and unbounded following"
    levels = events.filter("event = 'level' and height > 0 and t is not null")
    chunks = (
        levels.selectExpr(*key_columns(), "t", "event_id", "height", f"t div {chunk_ms}L as chunk")
        .selectExpr(
            "*",
            f"lag(height) over ({in_chunk}) as prev",
            f"first(height) over ({in_chunk} {whole}) as head",
            f"last(height) over ({in_chunk} {whole}) as tail",
        )
        .groupBy(*keys, "head", "tail")
        .agg(*exprs(
            "count(1) as levels", "count_if(height > prev) as ups", "count_if(height < prev) as downs"
        ))
    )
    linked = chunks.selectExpr("*", f"lag(tail) over (partition by {', '.join(KEYS)} order by chunk) as before")
    return linked.groupBy(*KEYS).agg(*exprs(
        "sum(levels) as level_events",
        "sum(ups + if(head > before, 1, 0)) as upshifts",
        "sum(downs + if(head < before, 1, 0)) as downshifts",
    ))


def segment_failures(
    events: DataFrame, interval_ms: int = HEARTBEAT_INTERVAL_MS, chunk_ms: int = CHUNK_MS
) -> DataFrame:
    """Requests for fragments that were never loaded, per label in force at the request.

    Requests and loads meet by viewer and ``segment_id``: a load after a switch still answers its request, and
    a retry that loads answers all requests of the segment. A request without a segment id stands alone.
    """
    rows = asof_quality(events, interval_ms, chunk_ms, ["segment_id"])
    segment = "if(segment_id is null, struct(event_id as id, true as alone), struct(segment_id as id, false as alone))"
    keyed = rows.selectExpr(*KEYS, f"inline(array({segment}))", "quality_label", "event")
    counts = keyed.groupBy(*KEYS, "id", "alone", "quality_label").agg(*exprs(
        f"count_if({REQUESTS}) as requests", f"count_if({LOADS}) as loads"
    ))
    answered = counts.selectExpr(
        "quality_label", "requests", f"sum(loads) over (partition by {', '.join(KEYS)}, id, alone) > 0 as answered"
    )
    totals = answered.groupBy("quality_label").agg(*exprs(
        "sum(requests) as requests", "sum(if(answered, requests, 0L)) as loads"
    ))
    failed = totals.filter("requests > 0").selectExpr("*", "requests - loads as failures")
    return failed.selectExpr("*", f"{S.safe_ratio('failures', 'requests')} as failure_rate")


def _server_window(df: DataFrame, window_ms: int) -> DataFrame:
    return df.selectExpr(
        *key_columns(),
        f"{S.server_time(SERVER)} as server_ms",
        f"{S.server_time(SERVER)} div {window_ms}L * {window_ms} as window_start_ms",
        f"{S.or_zero('player.bufferings')} as bufferings",
        f"{S.or_zero('player.bufferingTime')} as buffering_ms",
        f"{S.received_bytes('totalDistribution')} as received_bytes",
    )


def buffering_spikes(
    df: DataFrame, window_ms: int = HEARTBEAT_INTERVAL_MS, threshold: float = SPIKE_SHARE
) -> DataFrame:
    """Windows in which the share of a content's viewers that buffered reaches the threshold."""
    content = ["customerId", "contentId", "window_start_ms"]
    per_viewer = _server_window(df, window_ms).groupBy(*content, "clientId").agg(
        *exprs("max(if(bufferings > 0, 1, 0)) as buffered")
    )
    counts = per_viewer.groupBy(*content).agg(*exprs("count(1) as viewers", "sum(buffered) as buffering_viewers"))
    shares = counts.selectExpr("*", f"{S.safe_ratio('buffering_viewers', 'viewers')} as buffering_share")
    return shares.filter(f"buffering_share >= {threshold}D")


WINDOW_SUMS = [
    "count(1) as heartbeats",
    "count_if(bufferings > 0) as heartbeats_with_buffering",
    "sum(bufferings) as bufferings",
    "sum(buffering_ms) as buffering_ms",
    "sum(received_bytes) as received_bytes",
]


def window_metrics(df: DataFrame, window_ms: int = HEARTBEAT_INTERVAL_MS, latest: bool = False) -> DataFrame:
    """Heartbeats, stalls and bytes per customer's content and server-time window; on request the latest server time."""
    sums = [*WINDOW_SUMS, "max(server_ms) as latest_ms"] if latest else WINDOW_SUMS
    return _server_window(df, window_ms).groupBy("customerId", "contentId", "window_start_ms").agg(*exprs(*sums))
