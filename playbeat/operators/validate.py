"""Range checks on session metrics: a session that fails one is set aside with the reasons."""

from __future__ import annotations

from pyspark.sql import DataFrame

from playbeat.functions.scalars import LONG_MAX

RULES = {
    "buffering_ratio_negative": "buffering_ratio < 0",
    "p2p_ratio_out_of_range": "not p2p_ratio between 0 and 1",
    "counter_overflow": (
        "total_buffering_events is null or total_buffering_time_ms is null or total_received_bytes is null "
        f"or p2p_received_bytes is null or exists(quality_breakdown, q -> q.received_bytes = {LONG_MAX}L)"
    ),
    "watch_time_out_of_range": f"watch_time_ms = {LONG_MAX}L",
    "share_pct_out_of_range": "exists(quality_breakdown, q -> not q.share_pct between 0 and 100)",
}


def violations() -> str:
    """Names of the rules a metrics row breaks."""
    checks = [f"if({broken}, '{name}', null)" for name, broken in RULES.items()]
    return f"array_compact(array({', '.join(checks)}))"


def validate_metrics(metrics: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected); the rejected rows carry ``reasons``."""
    checked = metrics.selectExpr("*", f"{violations()} as reasons")
    valid = checked.filter("size(reasons) = 0").drop("reasons")
    return valid, checked.filter("size(reasons) > 0")
