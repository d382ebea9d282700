"""Mergeable session state: partial metrics of any part of a session's heartbeats.

Counts and bytes add up, the span takes minimum and maximum, the agent clock and date follow the
first and last server time, and label bytes add per label. Merging is associative and commutative,
so heartbeats may be split over batches in any way.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, types as T

from playbeat.functions.ordering import ServerOrdered
from playbeat.operators.quality import session_labels
from playbeat.operators.sessions import DAY, SUMS, fold_labels, session_keys, with_label_rows
from playbeat.plans.metrics import finish_metrics
from playbeat.schema import HEARTBEAT_INTERVAL_MS, KEYS, OBSERVED_LABELS

ADDED = ["snapshot_count", *SUMS]
SPAN = ["session_start_ms", "first_agent_ms", "session_end_ms", "last_agent_ms"]

PARTIAL = T.StructType(
    [T.StructField(k, T.StringType()) for k in KEYS]
    + [T.StructField("eventDate", T.DateType())]
    + [T.StructField(c, T.LongType()) for c in ADDED + SPAN]
    + [T.StructField("quality", T.MapType(T.StringType(), T.LongType()))]
)

HEAD = ServerOrdered("head", "session_start_ms", "first_agent_ms")
TAIL = ServerOrdered("tail", "session_end_ms", "last_agent_ms")
FIRST_DAY = ServerOrdered("day", "session_start_ms", DAY.value, DAY.base)


def session_partials(df: DataFrame, labels: Sequence[str] = OBSERVED_LABELS) -> DataFrame:
    """Partial state per session and event date."""
    totals = session_labels(df, by_date=True, labels=labels)
    return totals.selectExpr(*PARTIAL.fieldNames()[:-1], "map_from_entries(labels) as quality")


def merge_partials(*parts: DataFrame, by_date: bool = True) -> DataFrame:
    """Merge partial states to one row per session; without ``by_date`` dates of a session merge too."""
    rows = reduce(DataFrame.unionByName, parts)
    keys = session_keys(by_date)
    columns = [*ADDED, *SPAN, *([] if by_date else ["eventDate"])]
    entries = "transform(map_entries(quality), e -> struct(e.key as label, e.value as label_bytes))"
    spread = with_label_rows(rows, entries, keys, columns)
    spread = spread.selectExpr(
        "*", *HEAD.columns(), *TAIL.columns(), *([] if by_date else FIRST_DAY.columns()), "label is null as whole"
    )
    totals = fold_labels(spread, keys, [
        # a part whose sum did not fit makes the whole one null, too
        *[f"if(count({c}) < count_if(whole), null, try_sum({c})) as {c}" for c in ADDED],
        "min(session_start_ms) as session_start_ms",
        "max(session_end_ms) as session_end_ms",
        *HEAD.aggregates(last=False),
        *TAIL.aggregates(first=False),
        *([] if by_date else FIRST_DAY.aggregates(last=False)),
    ])
    day = "eventDate" if by_date else f"date_from_unix_date(cast({FIRST_DAY.first()} as int)) as eventDate"
    pairs = "transform(label_list, x -> struct(x.quality_label as key, x.received_bytes as value))"
    return totals.selectExpr(
        *KEYS,
        day,
        *ADDED,
        "session_start_ms",
        f"{HEAD.first()} as first_agent_ms",
        "session_end_ms",
        f"{TAIL.last()} as last_agent_ms",
        f"map_from_entries({pairs}) as quality",
    )


def finalize(
    partials: DataFrame, heartbeat_interval_ms: int = HEARTBEAT_INTERVAL_MS, min_snapshots: int = 1
) -> DataFrame:
    """Session metrics from merged partial state; row-wise, no shuffle."""
    labels = "transform(map_entries(quality), e -> struct(e.key as quality_label, e.value as received_bytes))"
    rows = partials.selectExpr(*PARTIAL.fieldNames()[:-1], f"{labels} as labels")
    return finish_metrics(rows, heartbeat_interval_ms, min_snapshots, "eventDate")
