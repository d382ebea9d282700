"""Windows by visit: a player that starts, stops or falls silent begins to count anew.

A visit begins with a ``start`` event, with the first event after a ``stop``, after a pause of more than the visit gap,
and with a viewer's first event; events of one time belong together. Its windows count from its first event. As in
the other player operators no window function spans a viewer's events: events are reduced to one row per second
first, and what one second tells the next goes through stretches of an hour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from playbeat.operators.player_events import CHUNK_MS, VISIT_GAP_MS, WINDOW_KEYS, _keyed, to_heartbeats, window_totals
from playbeat.operators.sessions import exprs
from playbeat.schema import HEARTBEAT_INTERVAL_MS, KEYS

STRETCH = 3_600
OF_VIEWER = ", ".join(KEYS)
EARLIER = "rows between unbounded preceding and 1 preceding"


def _carried(seconds: DataFrame, value: str, name: str) -> DataFrame:
    """Adds the largest ``value`` of a viewer's earlier seconds; it grows with time, so that is the last one."""
    stretches = seconds.groupBy(*KEYS, "stretch").agg(*exprs(f"max({value}) as last_of_stretch"))
    before = stretches.selectExpr(*KEYS, "stretch", f"max(last_of_stretch) over (partition by {OF_VIEWER} order by stretch {EARLIER}) as before")
    within = seconds.selectExpr("*", f"max({value}) over (partition by {OF_VIEWER}, stretch order by second {EARLIER}) as within")
    joined = within.join(before, on=[*KEYS, "stretch"])
    return joined.selectExpr(*seconds.columns, f"coalesce(within, before) as {name}")


def visit_starts(events: DataFrame, visit_gap_ms: int = VISIT_GAP_MS) -> DataFrame:
    """Per viewer and second with events: the times in it at which a visit starts, and the start of the visit before."""
    seconds = (
        _keyed(events).selectExpr(*KEYS, "t", "event", f"t div {CHUNK_MS}L as second")
        .groupBy(*KEYS, "second")
        # a second has at most CHUNK_MS times
        .agg(*exprs(
            "sort_array(collect_set(t)) as times",
            "collect_set(if(event = 'start', t, null)) as starts",
            "collect_set(if(event = 'stop', t, null)) as stops",
        ))
        .selectExpr(
            "*", f"second div {STRETCH} as stretch", "element_at(times, 1) as first_t",
            "struct(element_at(times, -1) as t, array_contains(stops, element_at(times, -1)) as stopped) as tail",
        )
    )
    told = _carried(seconds, "tail", "prior")
    anew = f"prior is null or prior.stopped or first_t - prior.t > {visit_gap_ms}"
    after_stop = "filter(times, (x, i) -> i > 0 and array_contains(stops, times[i - 1]))"
    marks = told.selectExpr(
        *KEYS, "stretch", "second", f"array_sort(array_union(array_union(starts, {after_stop}), if({anew}, array(first_t), array()))) as marks"
    ).selectExpr("*", "try_element_at(marks, -1) as last_mark")
    return _carried(marks, "last_mark", "visit_before").select(*KEYS, "second", "marks", "visit_before")


def assign_visit_windows(
    events: DataFrame, interval_ms: int = HEARTBEAT_INTERVAL_MS, clip_last: bool = False, visit_gap_ms: int = VISIT_GAP_MS
) -> DataFrame:
    """Adds ``visit`` (its first event's time), ``win``, ``win_start`` and ``win_end``.

    ``win`` is ``win_start`` again, which tells a viewer's windows apart across visits: a visit begins after the last
    event of the one before, so no two windows begin at one time. ``clip_last`` ends a visit's last window at its last event.
    """
    rows = _keyed(events)
    timed = rows.selectExpr("*", f"t div {CHUNK_MS}L as second").join(visit_starts(events, visit_gap_ms), on=[*KEYS, "second"])
    windowed = (
        timed.selectExpr(*rows.columns, "coalesce(array_max(filter(marks, m -> m <= t)), visit_before) as visit")
        .selectExpr("*", f"visit + (t - visit) div {interval_ms}L * {interval_ms} as win")
        .selectExpr("*", "win as win_start", f"win + {interval_ms} as win_end")
    )
    if not clip_last:
        return windowed
    ends = windowed.groupBy(*KEYS, "visit").agg(*exprs("max(t) as last_t"))
    return windowed.join(ends, on=[*KEYS, "visit"]).withColumn("win_end", exprs("least(win_end, last_t)")[0]).drop("last_t")


def quiet_visit_windows(windowed: DataFrame, interval_ms: int = HEARTBEAT_INTERVAL_MS) -> DataFrame:
    """The windows of a visit that hold no event, between its first and its last one."""
    held = windowed.select(*KEYS, "visit", "win").distinct()
    ahead = held.selectExpr("*", f"lead(win) over (partition by {OF_VIEWER}, visit order by win) as next_win")
    pauses = ahead.filter(f"next_win - win > {interval_ms}")
    quiet = pauses.selectExpr(*KEYS, f"explode(sequence(win + {interval_ms}, next_win - {interval_ms}, {interval_ms}L)) as win")
    return quiet.selectExpr(*WINDOW_KEYS, "win as win_start", f"win + {interval_ms} as win_end")


def visit_heartbeats(
    events: DataFrame,
    interval_ms: int = HEARTBEAT_INTERVAL_MS,
    clip_last: bool = False,
    quiet_windows: bool = True,
    visit_gap_ms: int = VISIT_GAP_MS,
    chunk_ms: int = CHUNK_MS,
) -> DataFrame:
    """Heartbeats as players send them from the start of a visit to its end, those of quiet windows included."""
    windowed = assign_visit_windows(events, interval_ms, clip_last, visit_gap_ms)
    totals = window_totals(windowed, chunk_ms)
    if quiet_windows:
        kind = totals.schema["quality"].dataType.simpleString()
        empty = f"cast(map() as {kind})"
        filled = quiet_visit_windows(windowed, interval_ms).selectExpr("*", "0L as bufferings", "0L as buffering_ms", f"{empty} as quality")
        totals = totals.unionByName(filled)
    return to_heartbeats(totals)
