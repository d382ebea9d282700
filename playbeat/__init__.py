"""Viewer quality-of-service telemetry as plain Spark DataFrame and streaming jobs."""

from playbeat.plans.metrics import compute_metrics, process_all
from playbeat.session import get_spark
from playbeat.sources.heartbeats import load_snapshots, read_telemetry

__all__ = ["compute_metrics", "get_spark", "load_snapshots", "process_all", "read_telemetry"]
