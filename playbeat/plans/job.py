"""Command line job: heartbeat table to session metrics, files and fleet summary."""

from __future__ import annotations

import argparse
import sys
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from playbeat.functions.scalars import session_key
from playbeat.operators.dedup import dedup_heartbeats
from playbeat.operators.sessions import exprs, keep_min_snapshots, key_columns
from playbeat.operators.summary import fleet_figures, label_counts, summary_of, summary_pct_of
from playbeat.operators.validate import violations
from playbeat.plans.metrics import compute_metrics
from playbeat.schema import HEARTBEAT_INTERVAL_MS, HEARTBEAT_NARROW, KEYS, OBSERVED_LABELS, SESSION_METRICS
from playbeat.session import get_spark, remove_dir
from playbeat.sinks.tables import SESSION_COLUMNS, replace_date, replace_sessions, write_csv, write_json, write_metrics
from playbeat.sources.date_index import dates_of_sessions, refresh_index
from playbeat.sources.heartbeats import filter_date, load_checked, read_for_metrics
from playbeat.sources.payload import CORRUPT, decode_payload, split_decoded
from playbeat.sources.quarantine import as_quarantine, split_clocks


REJECTED = T.StructType([*SESSION_METRICS.fields, T.StructField("reasons", T.ArrayType(T.StringType()))])


@dataclass(frozen=True)
class JobParams:
    input_path: str
    output_path: str
    date: str | None = None
    heartbeat_interval_ms: int = HEARTBEAT_INTERVAL_MS
    min_snapshots: int = 1
    fmt: str = "parquet"
    by_date: bool = False
    partition_by: tuple[str, ...] = ("event_date",)
    files: bool = True
    streaming: bool = False
    checkpoint: str | None = None
    trigger_interval: str | None = "30 seconds"
    labels: tuple[str, ...] = tuple(OBSERVED_LABELS)
    dedup: bool = False
    payload: bool = False


def parse_args(argv: list[str] | None = None) -> JobParams:
    p = argparse.ArgumentParser(description="Viewer quality-of-service metrics from heartbeats")
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--date", help="one event date, YYYY-MM-DD; without --by-date its sessions are read in full")
    p.add_argument("--heartbeat-interval-ms", type=int, default=HEARTBEAT_INTERVAL_MS)
    p.add_argument("--min-snapshots", type=int, default=1)
    p.add_argument("--format", default="parquet", choices=["parquet", "json", "orc", "delta"])
    p.add_argument("--by-date", action="store_true", help="split sessions at midnight")
    p.add_argument("--partition-by", default="event_date", help="comma-separated output partition columns")
    p.add_argument("--no-files", action="store_true", help="write the table only, no JSON and CSV")
    p.add_argument("--labels", default=",".join(OBSERVED_LABELS), help="quality labels to expect; others are found, too")
    p.add_argument("--dedup", action="store_true", help="count repeated heartbeats once")
    p.add_argument("--payload", action="store_true", help="the input holds JSON payloads: columns value and timestamp")
    p.add_argument("--streaming", action="store_true")
    p.add_argument("--checkpoint")
    p.add_argument("--trigger-interval", default="30 seconds", help="'once' reads what is there and stops")
    a = p.parse_args(argv)
    if a.streaming and not a.checkpoint:
        p.error("--checkpoint is required in streaming mode")
    if a.streaming and a.date:
        p.error("a stream has no single --date")
    if a.payload and a.date and not a.by_date:
        p.error("--payload with --date needs --by-date")
    return JobParams(
        a.input, a.output, a.date, a.heartbeat_interval_ms, a.min_snapshots, a.format, a.by_date,
        tuple(a.partition_by.split(",")), not a.no_files, a.streaming, a.checkpoint,
        None if a.trigger_interval == "once" else a.trigger_interval,
        tuple(x for x in a.labels.split(",") if x), a.dedup, a.payload,
    )


def _input_format(params: JobParams) -> str:
    """Heartbeat tables are parquet files, or delta where the output is delta."""
    return "delta" if params.fmt == "delta" else "parquet"


def _load(spark: SparkSession, params: JobParams, date: str | list[str] | None) -> tuple[DataFrame, list[DataFrame]]:
    """Heartbeats with usable values and clocks, and what was set aside, each with ``reasons``."""
    aside: list[DataFrame] = []
    if params.payload:
        decoded = decode_payload(spark.read.format(_input_format(params)).load(params.input_path))
        beats, corrupt = split_decoded(decoded)
        beats = filter_date(beats, date)
        aside.append(corrupt.selectExpr(f"{CORRUPT} as line", "array('payload') as reasons"))
    elif params.fmt == "delta":
        beats = read_for_metrics(spark, params.input_path, date, "delta")
    else:
        beats, bad = load_checked(spark, params.input_path, date, _input_format(params), HEARTBEAT_NARROW)
        aside += [] if bad is None else [bad]
    beats, clockless = split_clocks(beats)
    return (dedup_heartbeats(beats) if params.dedup else beats), [*aside, clockless]


def load_sessions(spark: SparkSession, params: JobParams, touched: DataFrame) -> DataFrame:
    """All heartbeats of the touched sessions, from the dates that the index of the table names; delta has none."""
    dates: list[str] | None = None
    if params.fmt != "delta":
        index = f"{params.output_path.rstrip('/')}/session_dates"
        known = refresh_index(spark, params.input_path, index, lambda days: _load(spark, params, days)[0])
        dates = dates_of_sessions(spark, index, known, touched)
    every = _load(spark, params, dates)[0] if dates is None or dates else _load(spark, params, params.date)[0].limit(0)
    match = " and ".join(f"{session_key(f'b.{k}')} = t.{k}" for k in KEYS)
    return every.alias("b").join(touched.alias("t"), F.expr(match), "left_semi")


FIGURES = "sessions bigint, rejected bigint, viewers bigint, viewers_with_buffering bigint, avg_buffering_ratio double, avg_p2p_ratio double"


def stage_metrics(metrics: DataFrame, min_snapshots: int, staged: str) -> dict:
    """Writes the sessions of enough heartbeats with the ``reasons`` against them; the counts and means of the run.

    They are observed on the rows as they are written. The observation stands in the write's own stage, in which the
    result of a task counts once, also where tasks or executors are lost.
    """
    enough = f"snapshot_count >= {min_snapshots}"
    checked = metrics.selectExpr("*", f"{violations()} as reasons")
    seen = Observation()
    rejected, valid = f"{enough} and size(reasons) > 0", f"({enough} and size(reasons) = 0)"
    watched = checked.observe(seen, *exprs("count(1) as sessions", f"count_if({rejected}) as rejected", *fleet_figures(valid)))
    keep_min_snapshots(watched, min_snapshots).write.parquet(staged)
    return seen.get


def print_summary(spark: SparkSession, figures: dict, labels: list) -> None:
    """The fleet summaries and the sessions by dominant label, from what the driver has already."""
    names = [field.split()[0] for field in FIGURES.split(", ")]
    row = spark.createDataFrame([tuple(figures[n] for n in names)], FIGURES)
    summary_of(row).show(truncate=False)
    summary_pct_of(row).show(truncate=False)
    led = [(r.quality_label, r.dominated) for r in labels if r.dominated]
    led = spark.createDataFrame(led, "dominant_quality string, count bigint")
    led.orderBy(F.desc("count"), "dominant_quality").show(truncate=False)


def run_batch(spark: SparkSession, params: JobParams) -> int:
    """0 when done or when there is nothing to do, 1 when the input is missing.

    The metrics are computed once, into a folder beside the output; the table and the files read that, and it is
    removed at the end. Counts and means are observed on that one write, and one aggregate over it gives the labels. A run over all dates replaces table, rejected sessions and quarantine. A run
    over one date replaces that date with ``--by-date``; without it a session may reach into other dates, so
    the dates on which the index of sessions finds those of this date are read and their rows are replaced wherever
    they are. The index is made by the first such run and brought up to date by later ones.
    """
    try:
        beats, aside = _load(spark, params, params.date)
    except FileNotFoundError as error:
        print(f"input not readable: {error}", file=sys.stderr)
        return 1
    out = params.output_path.rstrip("/")
    for i, bad in enumerate(aside):
        at = f"{out}/quarantine/part={i}" if params.date is None else f"{out}/quarantine_by_date/date={params.date}/part={i}"
        as_quarantine(bad).write.mode("overwrite").json(at)
    staged = f"{out}/_staging_{uuid.uuid4().hex}"
    touched = None
    if params.date is not None and not params.by_date:
        touched = beats.selectExpr(*key_columns()).distinct()
        beats = load_sessions(spark, params, touched)
        touched = touched.selectExpr(*[f"{k} as {c}" for k, c in zip(KEYS, SESSION_COLUMNS)])
    metrics = compute_metrics(beats, params.heartbeat_interval_ms, 1, params.by_date, params.labels)
    figures = stage_metrics(metrics, params.min_snapshots, staged)
    if not figures["sessions"]:
        print(f"{params.input_path} holds no usable heartbeat{f' of {params.date}' if params.date else ''}", file=sys.stderr)
        if params.date is None:
            remove_dir(spark, staged)
            return 0
    rows = spark.read.schema(REJECTED).parquet(staged)
    valid, rejected = rows.filter("size(reasons) = 0").drop("reasons"), rows.filter("size(reasons) > 0")
    table, set_aside = f"{out}/viewer_metrics", f"{out}/rejected_sessions"
    for rows, path, fmt, by in ((rejected, set_aside, "json", ("event_date",)), (valid, table, params.fmt, params.partition_by)):
        if params.date is None:
            write_metrics(rows, path, fmt, by, replace_table=True)
        elif params.by_date:
            replace_date(spark, rows, params.date, path, fmt, by)
        else:
            replace_sessions(spark, rows, touched, path, fmt, by)
    if figures["rejected"]:
        print(f"{figures['rejected']} sessions with values out of range are in {set_aside}", file=sys.stderr)
    if not figures["viewers"]:
        print(f"no session has {params.min_snapshots} heartbeats or more (min_snapshots)", file=sys.stderr)
    else:
        # labels, of which there are few, come to the driver: they name the columns of the CSV
        labels = list(label_counts(valid).toLocalIterator())
        if params.files:
            write_json(valid, f"{out}/viewer_metrics_json")
            write_csv(valid, f"{out}/viewer_metrics_csv", [r.quality_label for r in labels if r.sessions])
        print_summary(spark, figures, labels)
    remove_dir(spark, staged)
    return 0


def main(argv: list[str] | None = None) -> int:
    params = parse_args(argv)
    spark = get_spark()
    if params.streaming:
        from playbeat.streaming.sessions import run_streaming

        run_streaming(
            spark, params.input_path, params.output_path, params.checkpoint,
            params.trigger_interval, params.heartbeat_interval_ms, params.fmt, input_fmt=_input_format(params),
            payload=params.payload, dedup=params.dedup, by_date=params.by_date, min_snapshots=params.min_snapshots,
            partition_by=params.partition_by, labels=params.labels,
        )
        return 0
    return run_batch(spark, params)


if __name__ == "__main__":
    sys.exit(main())
