"""Registered queries: every operator over heartbeats or player events derived from the events table.

Nested results are flattened so that they compare with SQL; each query reads the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from playbeat.functions import maps as M, scalars as S
from playbeat.operators import insights, player_events as pe, quality as q, reshape, sessions as ses, summary, visits
from playbeat.operators.dedup import dedup_heartbeats as dedup
from playbeat.operators.validate import validate_metrics as validate
from playbeat.plans.job import JobParams, run_batch
from playbeat.plans.metrics import compute_metrics, sessions_sorted as by_key
from playbeat.plans.partials import finalize, merge_partials as merge, session_partials
from playbeat.schema import FLAT_COLUMNS, HEARTBEAT, KEYS, PLAYER_EVENT, SESSION_METRICS
from playbeat.session import make_dir, shared_dir
from playbeat.sinks.tables import SESSION_COLUMNS, upsert_metrics as upsert, write_metrics
from playbeat.sources import derived
from playbeat.sources.heartbeats import filter_date as on_date, read_telemetry, stream_telemetry
from playbeat.sources.payload import decode_payload as decode
from playbeat.sources.quarantine import coerce_types as coerce, split_malformed
from playbeat.streaming.running import running_metrics
from playbeat.streaming.sessions import start_sessions
from playbeat.streaming.visits import start_visit_stream
from playbeat.streaming.windows import all_windows, start_windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FILTER_DATE = "2024-01-10"
DAY_TEXT = "cast(eventDate as string) as eventDate"
LABEL_BYTES = M.long_total("quality_breakdown.received_bytes")

SCAN = [
    *KEYS,
    DAY_TEXT,
    "timestampInfo.server as server",
    "timestampInfo.agent as agent",
    "cast(player.bufferings as bigint) as bufferings",
    "cast(player.bufferingTime as bigint) as buffering_ms",
    "totalDistribution.sourceTraffic.receivedData as source_bytes",
    "totalDistribution.p2pTraffic.receivedData as p2p_bytes",
    "cast(coalesce(size(qualityDistribution), 0) as bigint) as labels",
]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _flat(metrics: DataFrame) -> DataFrame:
    """Scalar metrics with the date as text, and the size and bytes of the breakdown."""
    return metrics.selectExpr(
        *[c for c in FLAT_COLUMNS if c != "event_date"],
        "cast(event_date as string) as event_date",
        "cast(size(quality_breakdown) as bigint) as labels",
        f"{LABEL_BYTES} as label_bytes",
    )


def _table(spark: SparkSession, sf: str) -> str:
    """The derived heartbeats as a date-partitioned table in the shared folder."""
    path = shared_dir(spark, "heartbeats")
    beats = derived.heartbeats(spark, sf)
    beats.hint("rebalance", "eventDate").write.partitionBy("eventDate").parquet(path)
    return path


# --- scans and decoding


@query
def scan_heartbeats(spark, sf):
    return derived.heartbeats(spark, sf).selectExpr(*SCAN)


@query
def scan_table(spark, sf):
    """Written as a partitioned table and read back through the table source."""
    return read_telemetry(spark, _table(spark, sf)).selectExpr(*SCAN)


@query
def scan_table_date(spark, sf):
    return read_telemetry(spark, _table(spark, sf), FILTER_DATE).selectExpr(*SCAN)


@query
def filter_date(spark, sf):
    return on_date(derived.heartbeats(spark, sf), FILTER_DATE).selectExpr(*SCAN)


@query
def decode_payload(spark, sf):
    """JSON payloads back to heartbeats; a cut line keeps its text."""
    return decode(derived.payloads(spark, sf)).selectExpr(*SCAN, "_corrupt_record is not null as corrupt")


@query
def project_traffic(spark, sf):
    return q.explode_quality(derived.heartbeats(spark, sf)).selectExpr(
        *KEYS,
        "quality_label",
        "dist.sourceTraffic.requests as requests",
        "dist.sourceTraffic.responses as responses",
        "dist.sourceTraffic.requestedData as requested",
        "dist.sourceTraffic.receivedData as source_received",
        "dist.p2pTraffic.receivedData as p2p_received",
    )


@query
def decode_quality_map(spark, sf):
    """(label, bytes) pairs with repeated labels to a map: the last pair wins."""
    entries = "coalesce(map_entries(qualityDistribution), array())"
    first = f"transform({entries}, e -> struct(e.key as key, {S.received_bytes('e.value')} as value))"
    again = f"transform({entries}, e -> struct(e.key as key, {S.received_bytes('e.value')} + 1 as value))"
    rows = derived.heartbeat_rows(spark, sf).selectExpr("event_id", f"concat({first}, {again}) as pairs")
    return rows.selectExpr("event_id", f"explode_outer({M.pairs_to_map('pairs')}) as (quality_label, bytes)")


@query
def coerce_types(spark, sf):
    return coerce(derived.text_heartbeats(spark, sf)).selectExpr(*SCAN)


@query
def quarantine_rows(spark, sf):
    """Rows per quarantine reason; accepted rows have none."""
    valid, bad = split_malformed(derived.text_heartbeats(spark, sf))
    reasons = valid.selectExpr("'' as reason").unionAll(bad.selectExpr("array_join(reasons, ',') as reason"))
    return reasons.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


# --- scalar projections


@query
def project_flat(spark, sf):
    flat = ses.project_flat(derived.heartbeats(spark, sf))
    return flat.withColumn("eventDate", F.col("eventDate").cast("string"))


def _rows(spark, sf, *columns):
    return derived.heartbeat_rows(spark, sf).selectExpr("event_id", *columns)


@query
def null_defaults(spark, sf):
    return _rows(
        spark, sf,
        f"{S.or_zero('player.bufferings')} as bufferings",
        f"{S.or_zero('player.bufferingTime')} as buffering_ms",
    )


@query
def session_keys(spark, sf):
    """Keys with every 6th customer missing: the missing one is the empty string."""
    holed = _rows(spark, sf, "if(event_id % 6 <> 0, customerId, null) as customerId", "contentId", "clientId")
    return holed.selectExpr("event_id", *ses.key_columns())


@query
def agent_fallback(spark, sf):
    """Agent clock with every 3rd one set to 0."""
    zeroed = "if(event_id % 3 = 0, 0L, timestampInfo.agent)"
    return _rows(spark, sf, f"{S.agent_time(zeroed, 'timestampInfo.server')} as agent")


@query
def received_bytes(spark, sf):
    return _rows(spark, sf, f"{S.received_bytes('totalDistribution')} as received_bytes")


@query
def safe_ratio(spark, sf):
    ms, count = "player.bufferingTime", "player.bufferings"
    return _rows(
        spark, sf,
        f"{S.safe_ratio(ms, count)} as mean_or_zero",
        f"{S.safe_ratio(ms, count, 'null')} as mean_or_null",
        f"{S.capped_ratio(ms, f'({count} * 25000)')} as capped",
    )


@query
def epoch_to_date(spark, sf):
    return _rows(spark, sf, f"cast({S.epoch_date('timestampInfo.server')} as string) as day")


@query
def quality_label(spark, sf):
    levels = derived.player_events(spark, sf).filter("event = 'level'")
    return levels.selectExpr("event_id", f"{S.quality_label('height', 'level')} as quality_label")


@query
def map_totals(spark, sf):
    m = "qualityDistribution"
    return _rows(
        spark, sf,
        f"{M.map_total(m, 'requests')} as requests",
        f"{M.map_total(m, 'responses', 'double')} as responses",
        f"{M.map_total(m, 'requestedData')} as requested",
        f"{M.map_total(m, 'receivedData')} as received",
    )


# --- sessions


@query
def session_metrics(spark, sf):
    return _flat(compute_metrics(derived.heartbeats(spark, sf)))


@query
def session_metrics_by_date(spark, sf):
    return _flat(compute_metrics(derived.heartbeats(spark, sf), by_date=True))


@query
def buffering_by_date(spark, sf):
    out = ses.buffering_metrics(derived.heartbeats(spark, sf), by_date=True)
    return out.withColumn("event_date", F.col("event_date").cast("string"))


def _sessions(spark, sf, *columns):
    return ses.buffering_metrics(derived.heartbeats(spark, sf)).selectExpr(*KEYS, *columns)


@query
def session_span(spark, sf):
    return _sessions(
        spark, sf, "session_start_ms", "session_end_ms", "snapshot_count", "first_agent_ms", "last_agent_ms",
        "cast(event_date as string) as event_date",
    )


@query
def watch_time(spark, sf):
    return _sessions(spark, sf, "watch_time_ms")


@query
def buffering_totals(spark, sf):
    return _sessions(spark, sf, "total_buffering_events", "total_buffering_time_ms")


@query
def buffering_ratio(spark, sf):
    return _sessions(spark, sf, "buffering_ratio")


@query
def avg_buffering(spark, sf):
    return _sessions(spark, sf, "avg_buffering_duration_ms")


@query
def traffic_split(spark, sf):
    return _sessions(spark, sf, "total_received_bytes", "p2p_received_bytes", "p2p_ratio")


@query
def min_snapshots(spark, sf):
    return _flat(compute_metrics(derived.heartbeats(spark, sf), min_snapshots=14))


@query
def sessions_sorted(spark, sf):
    return by_key(_flat(compute_metrics(derived.heartbeats(spark, sf))))


@query
def validate_metrics(spark, sf):
    """Sessions of every 3rd viewer get negative peer bytes: they are set aside with a reason."""
    p2p = F.expr(
        "if(cast(substring(clientId, 2) as bigint) % 3 = 0, -totalDistribution.p2pTraffic.receivedData - 1, "
        "totalDistribution.p2pTraffic.receivedData)"
    )
    total = F.col("totalDistribution").withField("p2pTraffic.receivedData", p2p)
    beats = derived.heartbeats(spark, sf).withColumn("totalDistribution", total)
    valid, rejected = validate(compute_metrics(beats))
    columns = ["customer_id", "content_id", "client_id", "total_received_bytes", "p2p_received_bytes", "p2p_ratio"]
    return valid.selectExpr(*columns, "'' as reasons").unionAll(
        rejected.selectExpr(*columns, "array_join(reasons, ',') as reasons")
    )


# --- quality


def _per_label(spark, sf):
    return q.quality_bytes(derived.heartbeats(spark, sf))


def _entries(df: DataFrame) -> DataFrame:
    """Breakdown entries as rows with their position; the share is unrounded."""
    rows = df.selectExpr(
        *KEYS, "dominant_quality", f"{LABEL_BYTES} as total", "posexplode(quality_breakdown) as (pos, entry)"
    )
    return rows.selectExpr(
        *KEYS,
        "dominant_quality",
        "cast(pos + 1 as bigint) as position",
        "entry.quality_label as quality_label",
        "entry.received_bytes as received_bytes",
        f"{q.share_pct('entry.received_bytes', 'total')} as share",
    )


def _exploded(df: DataFrame) -> DataFrame:
    return df.selectExpr(*KEYS, DAY_TEXT, "quality_label", f"{S.received_bytes('dist')} as bytes")


@query
def explode_quality(spark, sf):
    return _exploded(q.explode_quality(derived.heartbeats(spark, sf)))


@query
def explode_quality_outer(spark, sf):
    return _exploded(q.explode_quality(derived.heartbeats(spark, sf), outer=True))


@query
def quality_bytes(spark, sf):
    return _per_label(spark, sf)


@query
def quality_share(spark, sf):
    return q.quality_share(_per_label(spark, sf))


@query
def quality_rank(spark, sf):
    ranked = q.quality_rank(_per_label(spark, sf))
    return ranked.withColumns({c: F.col(c).cast("long") for c in ("position", "quality_rank")})


@query
def dominant_quality(spark, sf):
    return q.dominant_quality(_per_label(spark, sf))


@query
def quality_breakdown(spark, sf):
    return _entries(q.quality_breakdown(_per_label(spark, sf)))


@query
def quality_metrics(spark, sf):
    return _entries(q.quality_metrics(derived.heartbeats(spark, sf)))


def _map_rows(df: DataFrame, *extra: str) -> DataFrame:
    rows = df.selectExpr(*KEYS, *extra, "explode(quality_breakdown) as (quality_label, v)")
    return rows.selectExpr(*KEYS, *extra, "quality_label", "v.received_bytes as received_bytes")


@query
def quality_map(spark, sf):
    return _map_rows(q.quality_map(_per_label(spark, sf)))


@query
def join_dominant_breakdown(spark, sf):
    return _map_rows(q.join_dominant_breakdown(_per_label(spark, sf)), "dominant_quality")


# --- reshaping, summaries, sinks


@query
def flat_rows(spark, sf):
    """Flat form, its labels found in the data; the shares are rounded to two places in the breakdown itself."""
    beats = derived.heartbeats(spark, sf)
    # the labels are those of the heartbeats' maps, which takes no second run of the metrics
    labels = [row.quality_label for row in q.explode_quality(beats).select("quality_label").distinct().toLocalIterator()]
    flat = reshape.flatten_metrics(compute_metrics(beats), labels)
    text = {
        "event_date": "cast(event_date as string) as event_date",
        "dominant_quality": f"{S.text_or_empty('dominant_quality')} as dominant_quality",
    }
    return flat.selectExpr(*[text.get(c, c) if c in FLAT_COLUMNS else f"`{c}`" for c in flat.columns])


@query
def distinct_labels(spark, sf):
    return reshape.distinct_labels(compute_metrics(derived.heartbeats(spark, sf)))


@query
def fleet_summary(spark, sf):
    """Means rounded to nine places: the order of a floating sum is not fixed on a cluster."""
    out = summary.fleet_summary(compute_metrics(derived.heartbeats(spark, sf)))
    return out.withColumn("avg_buffering_ratio", F.round("avg_buffering_ratio", 9))


@query
def fleet_summary_pct(spark, sf):
    return summary.fleet_summary_pct(compute_metrics(derived.heartbeats(spark, sf)), places=7)


@query
def dominant_distribution(spark, sf):
    return summary.dominant_distribution(compute_metrics(derived.heartbeats(spark, sf)))


@query
def write_roundtrip(spark, sf):
    """Metrics written as a date-partitioned table and read back."""
    path = shared_dir(spark, "metrics")
    write_metrics(compute_metrics(derived.heartbeats(spark, sf)), path)
    return _flat(spark.read.schema(SESSION_METRICS).parquet(path))


@query
def upsert_metrics(spark, sf):
    """By-date metrics, those of the later dates replaced by a recomputation with a 60 s interval."""
    beats = derived.heartbeats(spark, sf)
    current = compute_metrics(beats, by_date=True)
    later = beats.filter(F.col("eventDate") >= F.lit(FILTER_DATE).cast("date"))
    return _flat(upsert(current, compute_metrics(later, 60_000, by_date=True)))


@query
def stream_sessions(spark, sf):
    """The table as a stream, in several micro-batches through the streaming sink, and the published table read back."""
    stream = stream_telemetry(spark, _table(spark, sf), maxFilesPerTrigger="16")
    out = shared_dir(spark, "stream")
    start_sessions(stream, f"{out}/table", f"{out}/checkpoint", f"{out}/state", trigger_interval=None).awaitTermination()
    return _flat(spark.read.schema(SESSION_METRICS).parquet(f"{out}/table"))


@query
def running_sessions(spark, sf):
    """The table as a stream through one stateful query; of the rows that it gave for a session the last one."""
    stream = stream_telemetry(spark, _table(spark, sf), maxFilesPerTrigger="16")
    out = shared_dir(spark, "running")
    make_dir(spark, f"{out}/rows")  # a stream without rows writes none

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/rows/batch={batch_id}")

    writer = running_metrics(stream).writeStream.outputMode("update").foreachBatch(store)
    writer.option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema(T.StructType([*SESSION_METRICS.fields, T.StructField("batch", T.LongType())])).parquet(f"{out}/rows")
    last = rows.groupBy(*SESSION_COLUMNS).agg(F.max("batch").alias("batch"))
    return _flat(rows.join(last, [*SESSION_COLUMNS, "batch"]))


@query
def merge_partials(spark, sf):
    """Partials of three disjoint parts that together hold all rows, merged."""
    beats = derived.heartbeats(spark, sf)
    mapped, early = F.col("qualityDistribution").isNotNull(), F.col("eventDate") < F.lit(FILTER_DATE).cast("date")
    batches = [beats.filter(~mapped), beats.filter(mapped & early), beats.filter(mapped & ~early)]
    return _flat(finalize(merge(*[session_partials(b) for b in batches], by_date=False)))


@query
def rerun_date(spark, sf):
    """The job over all dates, then again over one date of the same input: nothing changes."""
    path, out = _table(spark, sf), shared_dir(spark, "job")
    for date in (None, FILTER_DATE):
        run_batch(spark, JobParams(path, out, date, files=False))
    return _flat(spark.read.schema(SESSION_METRICS).parquet(f"{out}/viewer_metrics"))


@query
def job_with_quarantine(spark, sf):
    """The job over a table with text counters, some of which are no whole numbers: those rows are set aside."""
    path, out = shared_dir(spark, "text"), shared_dir(spark, "job")
    derived.text_heartbeats(spark, sf).drop("event_id").hint("rebalance", "eventDate").write.partitionBy("eventDate").parquet(path)
    run_batch(spark, JobParams(path, out, files=False))
    return _flat(spark.read.schema(SESSION_METRICS).parquet(f"{out}/viewer_metrics"))


@query
def window_metrics(spark, sf):
    return insights.window_metrics(derived.heartbeats(spark, sf))


@query
def stream_windows(spark, sf):
    """The table as a stream whose files come in no order of time: windows closed by the watermark, late rows merged in."""
    stream = stream_telemetry(spark, _table(spark, sf), maxFilesPerTrigger="16")
    out = shared_dir(spark, "windows")
    start_windows(stream, f"{out}/windows", f"{out}/checkpoint", trigger_interval=None).awaitTermination()
    return all_windows(spark, f"{out}/windows")


# --- player events


@query
def assign_windows(spark, sf):
    rows = pe.assign_windows(derived.player_events(spark, sf))
    return rows.select(*KEYS, "event_id", "t", "win", "win_start", "win_end")


@query
def asof_quality(spark, sf):
    return pe.asof_quality(derived.player_events(spark, sf), columns=[])


@query
def buffer_intervals(spark, sf):
    return pe.buffer_intervals(derived.player_events(spark, sf))


@query
def window_quality_stats(spark, sf):
    return pe.window_quality_stats(derived.player_events(spark, sf))


BEAT = [
    *KEYS,
    "timestampInfo.agent as agent",
    DAY_TEXT,
    "cast(player.bufferings as bigint) as bufferings",
    "cast(player.bufferingTime as bigint) as buffering_ms",
    "totalDistribution.sourceTraffic.requests as requests",
    "totalDistribution.sourceTraffic.receivedData as received",
    "cast(size(qualityDistribution) as bigint) as labels",
]


@query
def build_heartbeats(spark, sf):
    beats = pe.build_heartbeats(derived.player_events(spark, sf), quiet_windows=False)
    return beats.selectExpr(*BEAT)


@query
def densify_windows(spark, sf):
    """With the heartbeats of all quiet windows of a visit."""
    return pe.build_heartbeats(derived.player_events(spark, sf)).selectExpr(*BEAT)


@query
def visit_heartbeats(spark, sf):
    """Windows by visit: some events are starts and stops, and a pause of half an hour ends a visit, too."""
    return visits.visit_heartbeats(derived.visit_events(spark, sf)).selectExpr(*BEAT)


@query
def stream_visits(spark, sf):
    """The same from a stream: slices of events, out of order by up to an hour, through keyed state; a restart between slices.

    The last slice is one event far ahead, as a stream that goes on would bring: it lets time pass, so all visits end.
    """
    path = shared_dir(spark, "visits")
    events = derived.visit_events(spark, sf)
    span = events.agg(F.min("t").alias("low"), F.max("t").alias("high")).first()
    if span.low is None:
        return visits.visit_heartbeats(events).selectExpr(*BEAT)
    slices = 4
    place = f"cast((t + event_id % 7 * 600000 - {span.low}) * {slices}D / {span.high - span.low + 3_600_001} as int)"
    ahead = spark.range(1).selectExpr(f"{span.high + 10_000_000_000}L as t", "'other' as event", "'~' as customerId")
    for i in range(slices + 1):
        part = events.filter(f"{place} = {i}") if i < slices else ahead
        part.write.mode("append").parquet(f"{path}/events")
        stream = spark.readStream.schema(PLAYER_EVENT).option("maxFilesPerTrigger", "1000000").parquet(f"{path}/events")
        start_visit_stream(stream, f"{path}/beats", f"{path}/checkpoint", "2 hours", None).awaitTermination()
    return spark.read.schema(HEARTBEAT).parquet(f"{path}/beats").selectExpr(*BEAT)


@query
def player_sessions(spark, sf):
    """Player events to heartbeats to session metrics."""
    return _flat(compute_metrics(pe.build_heartbeats(derived.player_events(spark, sf))))


# --- follow-on analyses


@query
def dedup_heartbeats(spark, sf):
    """All heartbeats twice, the copy with another agent time: each is kept once, with the smaller one."""
    beats = derived.heartbeats(spark, sf)
    info = F.col("timestampInfo")
    copy = beats.withColumn("timestampInfo", info.withField("agent", info["agent"] + 1))
    return dedup(beats.unionByName(copy)).selectExpr(*SCAN)


@query
def buffering_position(spark, sf):
    return insights.buffering_position(derived.player_events(spark, sf))


@query
def buffering_clusters(spark, sf):
    return insights.buffering_clusters(derived.player_events(spark, sf), bucket_ms=60_000)


@query
def quality_switches(spark, sf):
    return insights.quality_switches(derived.player_events(spark, sf))


@query
def segment_failures(spark, sf):
    return insights.segment_failures(derived.fragment_events(spark, sf))


@query
def buffering_spikes(spark, sf):
    return insights.buffering_spikes(derived.heartbeats(spark, sf))
