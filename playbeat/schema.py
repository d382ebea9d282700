"""Explicit schemas: heartbeats, wire payloads, player events and session metrics."""

from __future__ import annotations

from pyspark.sql import types as T

KEYS = ["customerId", "contentId", "clientId"]

# Fixed values of the data model.
HEARTBEAT_INTERVAL_MS = 30_000
OBSERVED_LABELS = ["1080p", "270p", "360p", "720p"]


def traffic(integer=T.LongType, real=T.DoubleType) -> T.StructType:
    return T.StructType([
        T.StructField("requests", integer()),
        T.StructField("responses", real()),
        T.StructField("requestedData", integer()),
        T.StructField("receivedData", integer()),
    ])


def distribution(leaf: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("sourceTraffic", leaf),
        T.StructField("p2pTraffic", leaf),
    ])


def _heartbeat(leaf: T.StructType, count, stamp, day) -> T.StructType:
    dist = distribution(leaf)
    return T.StructType(
        [T.StructField(k, T.StringType()) for k in KEYS]
        + [
            T.StructField("timestampInfo", T.StructType([
                T.StructField("server", stamp()), T.StructField("agent", stamp())])),
            T.StructField("player", T.StructType([
                T.StructField("bufferings", count()), T.StructField("bufferingTime", count())])),
            T.StructField("totalDistribution", dist),
            T.StructField("qualityDistribution", T.MapType(T.StringType(), dist)),
            T.StructField("eventDate", day()),
        ]
    )


DISTRIBUTION = distribution(traffic())
HEARTBEAT = _heartbeat(traffic(), T.LongType, T.LongType, T.DateType)

# What the session metrics read. Spark prunes struct leaves by itself, but not through an explode of
# the quality map, so the map value is declared with its two byte counters only.
HEARTBEAT_NARROW = _heartbeat(
    T.StructType([T.StructField("receivedData", T.LongType())]), T.LongType, T.LongType, T.DateType
)



def as_text(kind: T.DataType) -> T.DataType:
    """The same nesting with every leaf as text: the input of the quarantine split."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, as_text(f.dataType)) for f in kind.fields])
    return T.MapType(T.StringType(), as_text(kind.valueType)) if isinstance(kind, T.MapType) else T.StringType()


HEARTBEAT_TEXT = as_text(HEARTBEAT)

PLAYER_EVENT = T.StructType(
    [T.StructField(k, T.StringType()) for k in KEYS]
    + [
        T.StructField("t", T.LongType()),
        T.StructField("event_id", T.LongType()),
        T.StructField("event", T.StringType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("requested", T.LongType()),
        T.StructField("received", T.LongType()),
        T.StructField("segment_id", T.LongType()),
    ]
)

QUALITY_ENTRY = T.StructType([
    T.StructField("quality_label", T.StringType()),
    T.StructField("received_bytes", T.LongType()),
    T.StructField("share_pct", T.DoubleType()),
])

SESSION_METRICS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("content_id", T.StringType()),
    T.StructField("client_id", T.StringType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("session_start_ms", T.LongType()),
    T.StructField("session_end_ms", T.LongType()),
    T.StructField("watch_time_ms", T.LongType()),
    T.StructField("snapshot_count", T.LongType()),
    T.StructField("total_buffering_events", T.LongType()),
    T.StructField("total_buffering_time_ms", T.LongType()),
    T.StructField("buffering_ratio", T.DoubleType()),
    T.StructField("avg_buffering_duration_ms", T.DoubleType()),
    T.StructField("dominant_quality", T.StringType()),
    T.StructField("quality_breakdown", T.ArrayType(QUALITY_ENTRY)),
    T.StructField("total_received_bytes", T.LongType()),
    T.StructField("p2p_received_bytes", T.LongType()),
    T.StructField("p2p_ratio", T.DoubleType()),
])

METRIC_COLUMNS = SESSION_METRICS.fieldNames()
FLAT_COLUMNS = [c for c in METRIC_COLUMNS if c != "quality_breakdown"]
