"""Heartbeats and player events derived from the generic ``events`` table, in the telemetry schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from playbeat.schema import DISTRIBUTION, HEARTBEAT, HEARTBEAT_TEXT

BASE_MS = 1_704_067_200_000  # 2024-01-01 UTC

# Event type -> label, k % 4 -> label and height, event type -> player event.
LABEL_A = (
    "case event_type when 'view' then '1080p' when 'click' then '720p' "
    "when 'purchase' then '360p' when 'signup' then '270p' end"
)
LABEL_B = "element_at(array('1080p', '720p', '360p', '270p'), cast(k % 4 + 1 as int))"
HEIGHT = "element_at(array(1080, 720, 360, 270), cast(k % 4 + 1 as int))"
PLAYER_EVENT_OF_TYPE = (
    "case event_type when 'click' then 'waiting' when 'error' then 'stalled' when 'view' then 'playing' "
    "when 'signup' then 'level' when 'purchase' then 'frag' end"
)

VIEWER = ["concat('c', user_id % 3) as customerId", "concat('v', user_id) as clientId"]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table with integer microseconds and the integer k of its JSON properties."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "value",
        "cast(ts as timestamp) as ts",
        "unix_micros(cast(ts as timestamp)) as us",
        "cast(get_json_object(props, '$.k') as bigint) as k",
    )


def _traffic(received: str) -> str:
    return f"struct(1L as requests, 1D as responses, {received} as requestedData, {received} as receivedData)"


def _dist(source: str, p2p: str | None) -> str:
    none = f"cast(null as {DISTRIBUTION['p2pTraffic'].dataType.simpleString()})"
    return f"struct({_traffic(source)} as sourceTraffic, {_traffic(p2p) if p2p else none} as p2pTraffic)"


def _scaled(factor: int) -> str:
    return f"cast(round(value * {factor}) as bigint)"


def heartbeat_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heartbeats with the event id they were built from."""
    first, second = _dist("source", "p2p"), _dist("k * 1000", None)
    quality = (
        f"case when label_a = label_b then map(label_a, {first}) "
        f"when label_a is not null then map(label_a, {first}, label_b, {second}) end"
    )
    e = events(spark, sf_dir).selectExpr(
        "*",
        f"{BASE_MS} + (us - {BASE_MS}000) div 500000L as server",
        f"if(event_id % 5 = 0, {_scaled(300)}, 0L) as p2p",
        f"{_scaled(1000)} as source",
        f"{_scaled(1300)} as total",
        f"{LABEL_A} as label_a",
        f"{LABEL_B} as label_b",
    )
    return e.selectExpr(
        "event_id",
        *VIEWER,
        "concat('w', dayofmonth(ts) div 7) as contentId",
        "struct(server, if(event_id % 17 <> 0, server - event_id % 500, null) as agent) as timestampInfo",
        "struct(cast(case when event_type = 'error' then 1 + event_id % 3 when event_id % 11 <> 0 then 0 end as int) "
        "as bufferings, cast(case when event_type = 'error' then source when event_id % 11 <> 0 then 0 end as int) "
        "as bufferingTime) as player",
        f"{_dist('total', 'p2p')} as totalDistribution",
        f"{quality} as qualityDistribution",
        "cast(ts as date) as eventDate",
    ).select("event_id", *HEARTBEAT.fieldNames())


def heartbeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heartbeat_rows(spark, sf_dir).drop("event_id")


def player_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw player events; a ``frag`` row is a fragment request and its bytes in one."""
    frag_bytes = f"if(event = 'frag', {_scaled(1000)}, null)"
    return events(spark, sf_dir).selectExpr("*", f"{PLAYER_EVENT_OF_TYPE} as event").selectExpr(
        VIEWER[0],
        "'w0' as contentId",
        VIEWER[1],
        f"{BASE_MS} + (us - {BASE_MS}000) div 5000000L as t",
        "event_id",
        "event",
        f"if(event = 'level' and k % 10 <> 9, {HEIGHT}, null) as height",
        "cast(if(event = 'level', k % 4, null) as int) as level",
        f"{frag_bytes} as requested",
        f"{frag_bytes} as received",
        "if(event = 'frag', event_id, null) as segment_id",
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heartbeats as wire payloads: JSON text without a server clock, and its receipt time.

    Every 13th line is cut short, as a lost connection leaves it.
    """
    sent = [c for c in HEARTBEAT.fieldNames() if c != "timestampInfo"]
    body = f"to_json(struct({', '.join(sent)}, struct(timestampInfo.agent as agent) as timestampInfo))"
    return heartbeat_rows(spark, sf_dir).selectExpr(
        "event_id",
        f"if(event_id % 13 = 0, left({body}, 40), {body}) as value",
        "timestamp_millis(timestampInfo.server) as timestamp",
    )


def text_heartbeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heartbeats with text leaves; some counters hold text that is not a whole number."""
    counter = (
        "case when event_id % 19 = 0 then 'x' when event_id % 23 = 0 then '1.5' when event_id % 29 = 0 then '1.0' "
        "else cast(player.bufferings as string) end"
    )
    player = f"struct({counter} as bufferings, cast(player.bufferingTime as string) as bufferingTime) as player"
    text = heartbeat_rows(spark, sf_dir).selectExpr(
        *[player if c == "player" else c for c in ["event_id", *HEARTBEAT.fieldNames()]]
    )
    typed = [f"cast({f.name} as {f.dataType.simpleString()}) as {f.name}" for f in HEARTBEAT_TEXT.fields]
    return text.selectExpr("event_id", *typed)


def fragment_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player events with fragment requests and loads as rows of their own; every 7th request fails."""
    rows = player_events(spark, sf_dir)
    # every 5th load comes two seconds late, when another level may be in force
    late = "if(event = 'frag_loaded' and event_id % 5 = 0, t + 2000, t) as t"
    kinds = (
        "if(event = 'frag', array_compact(array('frag_loading', if(event_id % 7 <> 0, 'frag_loaded', null))), "
        "array(event))"
    )
    parts = rows.selectExpr(*[f"explode({kinds}) as event" if c == "event" else c for c in rows.columns])
    return parts.selectExpr(*[late if c == "t" else c for c in parts.columns])


def visit_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player events of which some are a start or a stop of the player."""
    rows = player_events(spark, sf_dir)
    kind = "case event_id % 40 when 0 then 'start' when 1 then 'stop' else event end as event"
    return rows.selectExpr(*[kind if c == "event" else c for c in rows.columns])
