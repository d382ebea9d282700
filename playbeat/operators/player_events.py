"""Heartbeats from raw player events: stall intervals, quality in force, 30 s windows.

What a player does with a few variables - "am I stalled", "which level am I on" - is a forward fill
over its events. One viewer may own a large part of the table, so no window function here spans a
viewer: each 30 s window is cut into chunks, rows are ordered within a chunk only, and what one chunk
hands to the next (last state, last label) travels through a table with one row per chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from playbeat.functions import scalars as S
from playbeat.functions.maps import map_total
from playbeat.operators.sessions import exprs, key_columns
from playbeat.schema import HEARTBEAT, HEARTBEAT_INTERVAL_MS, KEYS

CHUNK_MS = 1_000
VISIT_GAP_MS = 1_800_000  # a viewer without events for longer has left and come back

# Fixed values of the player event model.
STALLS = "event in ('waiting', 'stalled')"
RESUMES = "event = 'playing'"
LEVELS = "event = 'level'"
REQUESTS = "event in ('frag', 'frag_loading')"
LOADS = "event in ('frag', 'frag_loaded')"
NO_LABEL = "'unknown'"

WINDOW_KEYS = KEYS + ["win"]
CHUNK_KEYS = WINDOW_KEYS + ["chunk"]

STATE = f"case when {STALLS} then 1 when {RESUMES} then 0 end"
LABEL = f"if({LEVELS}, {S.quality_label('height', 'level')}, null)"

IN_CHUNK = f"partition by {', '.join(CHUNK_KEYS)} order by t, event_id"
IN_CHUNK_REVERSED = f"partition by {', '.join(CHUNK_KEYS)} order by t desc, event_id desc"
BEFORE = "rows between unbounded preceding and 1 preceding"
UP_TO = "rows between unbounded preceding and current row"
WHOLE = "rows between unbounded preceding and unbounded following"
OF_WINDOW = f"partition by {', '.join(WINDOW_KEYS)}"
EARLIER_CHUNKS = f"{OF_WINDOW} order by chunk range between unbounded preceding and 1 preceding"
LATER_CHUNKS = f"{OF_WINDOW} order by chunk desc range between unbounded preceding and 1 preceding"


def _keyed(events: DataFrame) -> DataFrame:
    others = [c for c in events.columns if c not in KEYS]
    return events.filter("t is not null").selectExpr(*key_columns(), *others)


def viewer_spans(events: DataFrame) -> DataFrame:
    """First and last event time per viewer.

    Joined with the events, a viewer with a large part of them makes a skewed join. Spark splits the
    skewed side at run time only when both inputs of the join come straight from a shuffle, and an
    aggregate on the join keys would not be shuffled again. Grouping by a hash next to the keys makes
    it so, at the price of one more shuffle of one row per viewer.
    """
    keyed = _keyed(events).selectExpr(*KEYS, f"xxhash64({', '.join(KEYS)}) as viewer_hash", "t")
    spans = keyed.groupBy(*KEYS, "viewer_hash").agg(*exprs("min(t) as first_t", "max(t) as last_t"))
    return spans.drop("viewer_hash")


def _window_end(interval_ms: int, clip_last: bool) -> str:
    full = f"win_start + {interval_ms}"
    return f"least({full}, last_t)" if clip_last else full


def assign_windows(
    events: DataFrame, interval_ms: int = HEARTBEAT_INTERVAL_MS, clip_last: bool = False
) -> DataFrame:
    """Adds ``win``, ``win_start`` and ``win_end``; windows count from the viewer's first event.

    ``clip_last`` ends the last window at the viewer's last event, as a player that stops does.
    """
    timed = _keyed(events).join(viewer_spans(events), on=KEYS)
    return (
        timed.selectExpr("*", f"(t - first_t) div {interval_ms}L as win")
        .selectExpr("*", f"first_t + win * {interval_ms} as win_start")
        .selectExpr("*", f"{_window_end(interval_ms, clip_last)} as win_end")
        .drop("first_t", "last_t")
    )


def align_windows(events: DataFrame, interval_ms: int = HEARTBEAT_INTERVAL_MS) -> DataFrame:
    """Windows aligned to the epoch instead of the viewer's start: needs no join, so it suits streams."""
    windowed = _keyed(events).selectExpr("*", f"t div {interval_ms}L as win")
    return windowed.selectExpr("*", f"win * {interval_ms} as win_start", f"(win + 1) * {interval_ms} as win_end")


def _with_chunks(windowed: DataFrame, chunk_ms: int) -> DataFrame:
    return windowed.selectExpr(
        "*", f"{STATE} as state", f"{LABEL} as label", f"(t - win_start) div {chunk_ms}L as chunk"
    )


def _chunked(windowed: DataFrame, chunk_ms: int, *columns: str) -> DataFrame:
    """Rows dealt by chunk.

    The explicit repartition matters: the join on the viewer leaves rows partitioned by viewer, which
    would satisfy the windows over chunks and keep a hot viewer in one task.
    """
    rows = _with_chunks(windowed, chunk_ms)
    return (rows.select(*CHUNK_KEYS, "t", "event_id", *columns) if columns else rows).repartition(*CHUNK_KEYS)


def _local_state(chunked: DataFrame) -> DataFrame:
    """State before each row and label at each row, as far as its own chunk tells."""
    return chunked.selectExpr(
        "*",
        *([f"last(state, true) over ({IN_CHUNK} {BEFORE}) as prev_state"] if "state" in chunked.columns else []),
        *([f"last(label, true) over ({IN_CHUNK} {UP_TO}) as local_label"] if "label" in chunked.columns else []),
    )


def _chunk_carry(chunked: DataFrame, value: str, *more: str) -> DataFrame:
    """Per chunk: the last ``value`` of earlier chunks, and ``more`` aggregates.

    A chunk's tail is taken with all columns of its row. Thereby rows and tails need the same columns of the
    exchange below, so Spark makes it once and both read it.
    """
    others = [c for c in chunked.columns if c not in CHUNK_KEYS]
    whole = f"max_by(struct({', '.join(others)}), if({value} is null, null, struct(t, event_id))) as tail"
    tails = chunked.groupBy(*CHUNK_KEYS).agg(*exprs(whole, *more))
    return tails.selectExpr("*", f"last(tail.{value}, true) over ({EARLIER_CHUNKS}) as carry_{value}").drop("tail")


def asof_quality(
    events: DataFrame,
    interval_ms: int = HEARTBEAT_INTERVAL_MS,
    chunk_ms: int = CHUNK_MS,
    columns: Sequence[str] = ("segment_id", "requested", "received"),
) -> DataFrame:
    """Each fragment event with the label in force at its time; ``unknown`` until a window has one.

    Name only the further ``columns`` that are used: dropping one later keeps the exchange from being shared.
    """
    chunked = _chunked(assign_windows(events, interval_ms), chunk_ms, "event", "label", *columns)
    rows = _local_state(chunked).filter(f"{REQUESTS} or {LOADS}")
    joined = rows.join(_chunk_carry(chunked, "label"), on=CHUNK_KEYS, how="left")
    label = f"coalesce(local_label, carry_label, {NO_LABEL})"
    return joined.selectExpr(
        *WINDOW_KEYS, "t", "event_id", "event", f"{label} as quality_label", *columns
    )


def buffer_intervals(
    events: DataFrame,
    interval_ms: int = HEARTBEAT_INTERVAL_MS,
    clip_last: bool = False,
    chunk_ms: int = CHUNK_MS,
) -> DataFrame:
    """One row per stall: starts at waiting/stalled unless already stalled, ends at playing.

    A stall still open at the window end is cut there and does not go on in the next window.
    """
    chunked = _chunked(assign_windows(events, interval_ms, clip_last).filter(f"{STALLS} or {RESUMES}"), chunk_ms, "state", "win_end")
    states = _local_state(chunked).selectExpr(
        "*", f"last(if(state = 0, t, null), true) over ({IN_CHUNK_REVERSED} {BEFORE}) as local_resume"
    )
    carry = _chunk_carry(chunked, "state", "min(if(state = 0, t, null)) as head_resume")
    carry = carry.selectExpr(*CHUNK_KEYS, "carry_state", f"last(head_resume, true) over ({LATER_CHUNKS}) as next_resume")
    joined = states.join(carry, on=CHUNK_KEYS, how="left")
    starts = joined.filter("state = 1 and coalesce(prev_state, carry_state, 0) = 0")
    return starts.selectExpr(
        *WINDOW_KEYS, "t as start_ms", "event_id", "coalesce(local_resume, next_resume, win_end) as end_ms"
    ).selectExpr("*", "end_ms - start_ms as duration_ms")


def _total(condition: str, value: str = "1L") -> str:
    return f"sum(if({condition}, {value}, 0L))"


COUNTERS = ["starts", "ends", "start_ms", "end_ms", "fragments", "requests", "requested", "received"]


def _window_label_rows(windowed: DataFrame, chunk_ms: int) -> DataFrame:
    """Stall and fragment counters per viewer, window and label in force.

    Counters are summed per chunk with what the chunk alone knows. A chunk that follows a stalled one
    has then miscounted exactly its first state event; that is put right from the previous chunk's last
    state, so rows cross the network once and chunk sums a second time.
    """
    starts = "(state = 1 and coalesce(prev_state, 0) = 0)"
    ends = "(state = 0 and prev_state = 1)"
    head = "(state is not null and prev_state is null)"
    chunks = (
        _local_state(_chunked(windowed, chunk_ms))
        .selectExpr(
            "*",
            "t - win_start as offset",
            f"last(state, true) over ({IN_CHUNK} {WHOLE}) as tail_state",
            f"last(label, true) over ({IN_CHUNK} {WHOLE}) as tail_label",
        )
        .groupBy(*CHUNK_KEYS, "win_start", "win_end", "tail_state", "tail_label", "local_label")
        .agg(*exprs(
            f"{_total(starts)} as starts",
            f"{_total(ends)} as ends",
            f"{_total(starts, 'offset')} as start_ms",
            f"{_total(ends, 'offset')} as end_ms",
            f"max(if({head}, state, null)) as head_state",
            f"max(if({head}, offset, null)) as head_ms",
            f"{_total(f'{REQUESTS} or {LOADS}')} as fragments",
            f"{_total(REQUESTS)} as requests",
            f"{_total(REQUESTS, 'coalesce(requested, 0L)')} as requested",
            f"{_total(LOADS, 'coalesce(received, 0L)')} as received",
        ))
    )
    carried = chunks.selectExpr(
        "*",
        f"coalesce(last(tail_state, true) over ({EARLIER_CHUNKS}), 0) = 1 as was_stalled",
        f"coalesce(local_label, last(tail_label, true) over ({EARLIER_CHUNKS}), {NO_LABEL}) as quality_label",
    )
    false_start = "(was_stalled and head_state = 1)"
    missed_end = "(was_stalled and head_state = 0)"
    corrected = {
        "starts": f"starts - if({false_start}, 1L, 0L)",
        "start_ms": f"start_ms - if({false_start}, head_ms, 0L)",
        "ends": f"ends + if({missed_end}, 1L, 0L)",
        "end_ms": f"end_ms + if({missed_end}, head_ms, 0L)",
    }
    return carried.groupBy(*WINDOW_KEYS, "win_start", "win_end", "quality_label").agg(
        *exprs(*[f"sum({corrected.get(c, c)}) as {c}" for c in COUNTERS])
    )


def window_quality_stats(
    events: DataFrame, interval_ms: int = HEARTBEAT_INTERVAL_MS, chunk_ms: int = CHUNK_MS
) -> DataFrame:
    """Requests and bytes per viewer, window and label."""
    rows = _window_label_rows(assign_windows(events, interval_ms), chunk_ms)
    return rows.filter("fragments > 0").select(*WINDOW_KEYS, "quality_label", "requests", "requested", "received")


def _traffic(requests: str, responses: str, requested: str, received: str) -> str:
    return (
        f"struct(cast({requests} as bigint) as requests, cast({responses} as double) as responses, "
        f"cast({requested} as bigint) as requestedData, cast({received} as bigint) as receivedData)"
    )


def _with_zero_p2p(source: str) -> str:
    return f"struct({source} as sourceTraffic, {_traffic('0', '0', '0', '0')} as p2pTraffic)"


def window_totals(windowed: DataFrame, chunk_ms: int = CHUNK_MS) -> DataFrame:
    """One row per viewer and non-empty window: stalls and the quality map."""
    dist = _with_zero_p2p(_traffic("requests", "requests", "requested", "received"))
    entry = f"if(fragments > 0, struct(quality_label as key, {dist} as value), null)"
    totals = _window_label_rows(windowed, chunk_ms).groupBy(*WINDOW_KEYS, "win_start", "win_end").agg(*exprs(
        "sum(starts) as bufferings",
        "sum(end_ms) - sum(start_ms) as closed_ms",
        "sum(starts) - sum(ends) as open_stalls",
        f"map_from_entries(collect_list({entry})) as quality",
    ))
    return totals.selectExpr(
        *WINDOW_KEYS,
        "win_start",
        "win_end",
        "bufferings",
        "closed_ms + open_stalls * (win_end - win_start) as buffering_ms",
        "quality",
    )


def densify_windows(
    totals: DataFrame, interval_ms: int = HEARTBEAT_INTERVAL_MS, visit_gap_ms: int = VISIT_GAP_MS
) -> DataFrame:
    """Adds the quiet windows within a visit, with zeros and an empty map.

    Windows with events that begin at most ``visit_gap_ms`` apart belong to one visit. Between visits a player
    sends nothing, so a wrong clock or a viewer who returns after days adds no windows, and a pair of windows
    adds at most ``visit_gap_ms / interval_ms``. One row per window with events is ordered per viewer.
    """
    after = f"lead(win) over (partition by {', '.join(KEYS)} order by win)"
    ahead = totals.selectExpr(*WINDOW_KEYS, "win_start", f"{after} as next_win")
    pauses = ahead.filter(f"next_win - win > 1 and (next_win - win) * {interval_ms} <= {visit_gap_ms}")
    quiet = pauses.selectExpr(*KEYS, "win as from_win", "win_start as from_start", "explode(sequence(win + 1, next_win - 1)) as win")
    kind = totals.schema["quality"].dataType.simpleString()
    filled = quiet.selectExpr(
        *WINDOW_KEYS,
        f"from_start + (win - from_win) * {interval_ms} as win_start",
        f"from_start + (win - from_win + 1) * {interval_ms} as win_end",
        "0L as bufferings",
        "0L as buffering_ms",
        f"cast(map() as {kind}) as quality",
    )
    return totals.selectExpr(*filled.columns[:-1], f"coalesce(quality, cast(map() as {kind})) as quality").unionByName(filled)


def to_heartbeats(totals: DataFrame) -> DataFrame:
    """Window rows in the heartbeat schema; agent and receipt time are the window end."""
    source = _traffic(
        map_total("quality", "requests"),
        map_total("quality", "responses", "double"),
        map_total("quality", "requestedData"),
        map_total("quality", "receivedData"),
    )
    return totals.selectExpr(
        *KEYS,
        "struct(win_end as server, win_end as agent) as timestampInfo",
        "struct(cast(bufferings as int) as bufferings, cast(buffering_ms as int) as bufferingTime) as player",
        f"{_with_zero_p2p(source)} as totalDistribution",
        "quality as qualityDistribution",
        f"{S.epoch_date('win_end')} as eventDate",
    ).select(*HEARTBEAT.fieldNames())


def build_heartbeats(
    events: DataFrame,
    interval_ms: int = HEARTBEAT_INTERVAL_MS,
    clip_last: bool = False,
    quiet_windows: bool = True,
    chunk_ms: int = CHUNK_MS,
    visit_gap_ms: int = VISIT_GAP_MS,
) -> DataFrame:
    """Heartbeats as the players would have sent them."""
    totals = window_totals(assign_windows(events, interval_ms, clip_last), chunk_ms)
    if quiet_windows:
        totals = densify_windows(totals, interval_ms, visit_gap_ms)
    return to_heartbeats(totals)
