"""Session metrics: one row per viewer session."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from playbeat.functions.maps import long_total
from playbeat.operators.quality import breakdown_entries, session_labels, with_dominant
from playbeat.operators.sessions import keep_min_snapshots, with_session_ratios
from playbeat.operators.validate import validate_metrics
from playbeat.schema import HEARTBEAT_INTERVAL_MS, METRIC_COLUMNS, OBSERVED_LABELS

RENAMED = {"customer_id": "customerId", "content_id": "contentId", "client_id": "clientId"}


def finish_metrics(totals: DataFrame, heartbeat_interval_ms: int, min_snapshots: int, day: str) -> DataFrame:
    """Session metrics from session totals with a ``labels`` array; row-wise, no shuffle."""
    rows = with_session_ratios(keep_min_snapshots(totals, min_snapshots), heartbeat_interval_ms)
    entries = breakdown_entries("labels", long_total("labels.received_bytes"))
    names = {**RENAMED, "event_date": day}
    return with_dominant(rows, "*", entries=entries).selectExpr(*[f"{names.get(c, c)} as {c}" for c in METRIC_COLUMNS])


def compute_metrics(
    df: DataFrame,
    heartbeat_interval_ms: int = HEARTBEAT_INTERVAL_MS,
    min_snapshots: int = 1,
    by_date: bool = False,
    labels: Sequence[str] = OBSERVED_LABELS,
) -> DataFrame:
    """Heartbeats to session metrics; ``by_date`` makes the event date part of the session key.

    ``labels`` are the labels to expect. The result does not depend on them, only the plan does.
    """
    totals = session_labels(df, by_date, labels)
    return finish_metrics(totals, heartbeat_interval_ms, min_snapshots, "eventDate" if by_date else "event_date")


def process_all(
    df: DataFrame,
    heartbeat_interval_ms: int = HEARTBEAT_INTERVAL_MS,
    min_snapshots: int = 1,
    by_date: bool = False,
    labels: Sequence[str] = OBSERVED_LABELS,
) -> tuple[DataFrame, DataFrame]:
    """Session metrics split into valid rows and rejected rows with their reasons."""
    return validate_metrics(compute_metrics(df, heartbeat_interval_ms, min_snapshots, by_date, labels))


def sessions_sorted(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy("customer_id", "content_id", "client_id", "event_date")
