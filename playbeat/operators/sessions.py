"""Session aggregates: span, watch time, buffering and traffic per viewer session."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from playbeat.functions import scalars as S
from playbeat.functions.ordering import ServerOrdered
from playbeat.schema import HEARTBEAT_INTERVAL_MS, KEYS

SERVER = "timestampInfo.server"
AGENT = ServerOrdered("agent", "server", "agent")
DAY = ServerOrdered("day", "server", "cast(unix_date(eventDate) as bigint)", lambda s: f"({s} div {S.DAY_MS})")

# Null where a sum does not fit a long: that session is set aside, the others go on.
SUMS = {
    "total_buffering_events": "try_sum(bufferings)",
    "total_buffering_time_ms": "try_sum(buffering_ms)",
    "total_received_bytes": "try_add(try_sum(source_bytes), try_sum(p2p_bytes))",
    "p2p_received_bytes": "try_sum(p2p_bytes)",
}
FLAT = ["server", "agent", "bufferings", "buffering_ms", "source_bytes", "p2p_bytes"]


def exprs(*texts: str) -> list[Column]:
    return [F.expr(t) for t in texts]


def session_keys(by_date: bool = False) -> list[str]:
    """A session is (customer, content, client); by_date splits it at midnight."""
    return KEYS + ["eventDate"] if by_date else list(KEYS)


def key_columns() -> list[str]:
    return [f"{S.session_key(k)} as {k}" for k in KEYS]


def project_flat(df: DataFrame, *more: str) -> DataFrame:
    """Early projection of the nested heartbeat to the columns the session aggregates need."""
    return df.selectExpr(
        *key_columns(),
        f"{S.event_date('eventDate', SERVER)} as eventDate",
        f"{S.server_time(SERVER)} as server",
        f"{S.agent_time('timestampInfo.agent', SERVER)} as agent",
        f"{S.or_zero('player.bufferings')} as bufferings",
        f"{S.or_zero('player.bufferingTime')} as buffering_ms",
        f"{S.source_bytes('totalDistribution')} as source_bytes",
        f"{S.p2p_bytes('totalDistribution')} as p2p_bytes",
        *more,
    )


def with_label_rows(df: DataFrame, entries: str, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Each row once with ``columns`` and a null label, and once per entry (label, bytes) with those alone.

    So totals and bytes per label come from one pass over the table.
    """
    kind = "array<struct<label:string,label_bytes:bigint>>"
    none = "array(struct(cast(null as string) as label, cast(null as bigint) as label_bytes))"
    both = f"concat(cast({none} as {kind}), coalesce(cast({entries} as {kind}), cast(array() as {kind})))"
    rows = df.selectExpr(*keys, *columns, f"inline({both}) as (label, label_bytes)")
    return rows.selectExpr(*keys, "label", "label_bytes", *[f"if(label is null, {c}, null) as {c}" for c in columns])


def fold_labels(rows: DataFrame, keys: Sequence[str], aggregates: Sequence[str]) -> DataFrame:
    """One row per key from label rows: the aggregates of the null label, and ``label_list`` of the others.

    The rows meet by key and label in a hash aggregate that combines on the map side; what the second
    aggregate gathers per key are its labels, already summed.
    """
    first = rows.groupBy(*keys, "label").agg(*exprs(*aggregates, f"{S.held_sum('label_bytes')} as label_bytes"))
    measures = [c for c in first.columns if c not in (*keys, "label", "label_bytes")]
    entry = "if(label is null, null, struct(label as quality_label, label_bytes as received_bytes))"
    return first.groupBy(*keys).agg(
        *exprs(*[f"max({c}) as {c}" for c in measures], f"collect_list({entry}) as label_list")
    )


def session_totals(
    flat: DataFrame, by_date: bool = False, added: Sequence[str] = (), entries: str | None = None
) -> DataFrame:
    """One row per session: count, span, sums, and the agent clock of the first and last heartbeat.

    ``added`` names further columns to sum; ``entries`` is an array of (label, bytes) per row, which comes back
    summed per label as ``label_list``.

    Every buffer is a primitive, so this is a hash aggregate that combines on the map side: a session
    holding a third of all rows reaches the shuffle as one row per task.
    """
    keys = session_keys(by_date)
    aggregates = [
        "min(server) as session_start_ms",
        "max(server) as session_end_ms",
        "count(server) as snapshot_count",  # never null in a heartbeat's row
        *[f"{x} as {name}" for name, x in SUMS.items()],
        *[f"{S.held_sum(name)} as {name}" for name in added],
        *AGENT.aggregates(),
        *([] if by_date else DAY.aggregates(last=False)),
    ]
    if entries is not None:
        flat = with_label_rows(flat, entries, keys, [*FLAT, *added, *([] if by_date else ["eventDate"])])
    clocks = flat.selectExpr("*", *AGENT.columns(), *([] if by_date else DAY.columns()))
    if entries is None:
        totals = clocks.groupBy(*keys).agg(*exprs(*aggregates))
    else:
        totals = fold_labels(clocks, keys, aggregates)
    day = "eventDate" if by_date else f"date_from_unix_date(cast({DAY.first()} as int))"
    return totals.selectExpr(
        *KEYS,
        f"{day} as event_date",
        "session_start_ms",
        "session_end_ms",
        "snapshot_count",
        *SUMS,
        f"{AGENT.first()} as first_agent_ms",
        f"{AGENT.last()} as last_agent_ms",
        *added,
        *([] if entries is None else ["label_list"]),
    )


def with_session_ratios(totals: DataFrame, interval_ms: int = HEARTBEAT_INTERVAL_MS) -> DataFrame:
    """Watch time and the ratios that follow from session totals.

    A span beyond a long (absurd agent clocks) is held at the limits, so that one session does not fail the
    job; the session checks set it aside.
    """
    span = f"try_add(try_subtract(last_agent_ms, first_agent_ms), {interval_ms}L)"
    beyond = f"if(last_agent_ms > first_agent_ms, {S.LONG_MAX}L, 0L)"
    watch = f"greatest(coalesce({span}, {beyond}), {interval_ms}L)"
    return totals.selectExpr("*", f"{watch} as watch_time_ms").selectExpr(
        "*",
        f"{S.capped_ratio('total_buffering_time_ms', 'watch_time_ms')} as buffering_ratio",
        f"{S.safe_ratio('total_buffering_time_ms', 'total_buffering_events', 'null')} as avg_buffering_duration_ms",
        f"{S.safe_ratio('p2p_received_bytes', 'total_received_bytes')} as p2p_ratio",
    )


def buffering_metrics(
    df: DataFrame, interval_ms: int = HEARTBEAT_INTERVAL_MS, by_date: bool = False, min_snapshots: int = 1
) -> DataFrame:
    """Session totals and ratios of a heartbeat table, without the quality part."""
    totals = session_totals(project_flat(df), by_date)
    return with_session_ratios(keep_min_snapshots(totals, min_snapshots), interval_ms)


def keep_min_snapshots(totals: DataFrame, n: int = 1) -> DataFrame:
    """Drop sessions with fewer than n heartbeats."""
    return totals if n <= 1 else totals.filter(f"snapshot_count >= {n}")
