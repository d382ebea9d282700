"""Heartbeats from a stream of raw player events.

A window's events may arrive in several micro-batches and in any order, so the events themselves are
kept: each batch is stored under its slot of time, the identity of its checkpoint and its id (a replay replaces
its own files, and several checkpoints may fill one log), and the slots it touched are read by path and rebuilt
with the batch operators. Slots are whole numbers of heartbeat windows, aligned to the epoch. Windows that count
from a viewer's own first event, quiet and last windows are what `streaming.visits` makes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from playbeat.operators.player_events import CHUNK_MS, align_windows, to_heartbeats, window_totals
from playbeat.schema import HEARTBEAT_INTERVAL_MS, PLAYER_EVENT
from playbeat.session import query_id

SLOT_MS = 300_000


def heartbeats_aligned(
    events: DataFrame, interval_ms: int = HEARTBEAT_INTERVAL_MS, chunk_ms: int = CHUNK_MS
) -> DataFrame:
    """Heartbeats of epoch-aligned windows that hold at least one event."""
    return to_heartbeats(window_totals(align_windows(events, interval_ms), chunk_ms))


def player_sink(log_path: str, output_path: str, interval_ms: int, slot_ms: int, chunk_ms: int, checkpoint_path: str):
    def process(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # it is read for its slots and for the log
        try:
            store(batch, batch_id)
        finally:
            batch.unpersist()

    def store(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        slot = F.floor(F.col("t") / F.lit(slot_ms))
        rows = batch.filter(F.col("t").isNotNull()).select(
            *PLAYER_EVENT.fieldNames(), slot.alias("slot"), F.lit(f"{query_id(spark, checkpoint_path)}-{batch_id}").alias("batch")
        )
        slots = [row.slot for row in rows.select("slot").distinct().toLocalIterator()]
        (
            rows.hint("rebalance", "slot")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("slot", "batch")
            .parquet(log_path)
        )
        touched = [f"{log_path}/slot={s}" for s in slots]
        log = spark.read.schema(PLAYER_EVENT).option("basePath", log_path).parquet(*touched)
        beats = heartbeats_aligned(log, interval_ms, chunk_ms)
        # the window end belongs to the window before it, so its slot is that of the last millisecond
        beat_slot = F.floor((F.col("timestampInfo.agent") - 1) / F.lit(slot_ms))
        (
            beats.withColumn("slot", beat_slot)
            .hint("rebalance", "slot")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("slot")
            .parquet(output_path)
        )

    return process


def start_player_stream(
    events: DataFrame,
    log_path: str,
    output_path: str,
    checkpoint_path: str,
    trigger_interval: str | None = "30 seconds",
    interval_ms: int = HEARTBEAT_INTERVAL_MS,
    slot_ms: int = SLOT_MS,
    chunk_ms: int = CHUNK_MS,
) -> StreamingQuery:
    """Player events to a heartbeat table partitioned by time slot."""
    if slot_ms % interval_ms:
        raise ValueError("slot_ms must be a multiple of interval_ms")
    sink = player_sink(log_path, output_path, interval_ms, slot_ms, chunk_ms, checkpoint_path)
    writer = events.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint_path)
    if trigger_interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger_interval).start()
