"""Session metrics over a stream of heartbeats.

Totals across micro-batches are kept as mergeable partials in files, not in operator state:

    <state>/layout/buckets=N                   the number of buckets, set when the state begins
    <state>/delta/<query>-<batch>/bucket=B     partials of a micro-batch; a replay replaces its own
    <state>/base/seq=K/bucket=B                partials of bucket B merged by compaction K
    <state>/commits/seq=K                      what compaction K left: each bucket's base, and the deltas in them

A bucket is a hash of customer and content, as a live event keeps its viewers together: a micro-batch touches the
buckets of the contents it has, and nothing else of state or table is opened. ``<query>`` is the identity of the
checkpoint, so a state folder may be fed by several checkpoints, one after another or side by side in turn, and each
heartbeat counts once. What is in a base is listed by name: nothing depends on batch numbers or on how often compaction
runs, which may change at any restart. A reader takes the newest commit, the bases it names and the deltas it does not.
A driver or executor lost at any point leaves a state that reads as before: a folder counts only when its write was
completed. A compaction removes the deltas and bases that the commit before it had already replaced, so neither listing
nor reading grows with the stream's age.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from playbeat.functions import scalars as S
from playbeat.operators.dedup import dedup_stream
from playbeat.operators.insights import WINDOW_SUMS
from playbeat.operators.quality import quality_bytes
from playbeat.operators.sessions import SERVER, exprs, project_flat, session_totals, with_session_ratios
from playbeat.operators.validate import validate_metrics
from playbeat.plans.metrics import compute_metrics
from playbeat.plans.partials import PARTIAL, finalize, merge_partials, session_partials
from playbeat.schema import HEARTBEAT_INTERVAL_MS, KEYS, OBSERVED_LABELS
from playbeat.session import list_dir, make_dir, query_id, remove_dir
from playbeat.sinks.tables import METRIC_KEYS, SESSION_COLUMNS, replace_partitions, replace_sessions
from playbeat.sources.heartbeats import stream_telemetry
from playbeat.sources.payload import decode_payload, split_decoded
from playbeat.sources.quarantine import as_quarantine, split_clocks

COMMIT = T.StructType([
    T.StructField("bucket", T.IntegerType()), T.StructField("base", T.LongType()), T.StructField("delta", T.StringType()),
])
BUCKETS = 16
PAYLOAD_ROW = "value string, timestamp timestamp"


def _complete(spark: SparkSession, path: str) -> bool:
    return "_SUCCESS" in list_dir(spark, path)


def bucket_count(spark: SparkSession, state_path: str, wanted: int = BUCKETS) -> int:
    """The state's number of buckets; a state that begins now gets the wanted one."""
    names = list_dir(spark, f"{state_path}/layout")
    if not names:
        make_dir(spark, f"{state_path}/layout/buckets={wanted}")
    return int(names[0].split("=")[1]) if names else wanted


def bucket_of(buckets: int, customer: str = "customerId", content: str = "contentId") -> Column:
    return F.pmod(F.xxhash64(customer, content), F.lit(buckets)).cast("int").alias("bucket")


def _buckets_in(spark: SparkSession, path: str) -> list[int]:
    return [int(x.split("=")[1]) for x in list_dir(spark, path) if x.startswith("bucket=")]


def last_commit(spark: SparkSession, state_path: str) -> tuple[int, dict, set[str]]:
    """(number, base of each bucket, names of the deltas in them) of the newest completed compaction; -1 before the first.

    A long per bucket and the deltas of one compaction come to the driver.
    """
    numbers = sorted((int(x.split("=")[1]) for x in list_dir(spark, f"{state_path}/commits")), reverse=True)
    for k in numbers:
        path = f"{state_path}/commits/seq={k}"
        if _complete(spark, path):
            rows = list(spark.read.schema(COMMIT).json(path).toLocalIterator())
            return k, {r.bucket: r.base for r in rows if r.delta is None}, {r.delta for r in rows if r.delta is not None}
    return -1, {}, set()


def open_deltas(spark: SparkSession, state_path: str) -> list[str]:
    """Names of the completed deltas that are in no committed base."""
    merged = last_commit(spark, state_path)[2]
    names = [x for x in list_dir(spark, f"{state_path}/delta") if x not in merged]
    return [x for x in names if _complete(spark, f"{state_path}/delta/{x}")]


def _partials(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Partials in the given bucket folders; a bucket is known from its rows, so the folders' names are not read."""
    if not paths:
        return spark.createDataFrame([], PARTIAL)
    return spark.read.schema(PARTIAL).option("recursiveFileLookup", "true").parquet(*paths)


def _delta_paths(spark: SparkSession, state_path: str, names: Sequence[str], buckets: set[int] | None = None) -> list[str]:
    found = [(x, b) for x in names for b in _buckets_in(spark, f"{state_path}/delta/{x}")]
    return [f"{state_path}/delta/{x}/bucket={b}" for x, b in found if buckets is None or b in buckets]


def read_deltas(spark: SparkSession, state_path: str, names: Sequence[str]) -> DataFrame:
    return _partials(spark, _delta_paths(spark, state_path, names))


def read_state(spark: SparkSession, state_path: str, buckets: set[int] | None = None) -> DataFrame:
    """Unmerged partials of the given buckets, or of all: bases and the deltas that are not in them."""
    bases = last_commit(spark, state_path)[1]
    paths = [f"{state_path}/base/seq={k}/bucket={b}" for b, k in bases.items() if buckets is None or b in buckets]
    return _partials(spark, paths + _delta_paths(spark, state_path, open_deltas(spark, state_path), buckets))


def _write_buckets(partials: DataFrame, path: str, buckets: int) -> None:
    rows = partials.withColumn("bucket", bucket_of(buckets))
    rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)


def write_delta(partials: DataFrame, state_path: str, name: str, buckets: int = BUCKETS) -> None:
    """Store a micro-batch's partials; writing the same batch again replaces it."""
    _write_buckets(partials, f"{state_path}/delta/{name}", bucket_count(partials.sparkSession, state_path, buckets))


def compact_state(spark: SparkSession, state_path: str) -> None:
    """Merge all open deltas into new bases of their buckets, commit, and remove what the commit before had replaced."""
    seq, bases, merged = last_commit(spark, state_path)
    names = open_deltas(spark, state_path)
    if not names:
        return
    touched = {b for x in names for b in _buckets_in(spark, f"{state_path}/delta/{x}")}
    base = f"{state_path}/base/seq={seq + 1}"
    _write_buckets(merge_partials(read_state(spark, state_path, touched)), base, bucket_count(spark, state_path))
    now = {**bases, **{b: seq + 1 for b in touched}}
    rows = [(b, k, None) for b, k in now.items()] + [(None, None, x) for x in names]
    commit = spark.createDataFrame(rows, COMMIT).coalesce(1)
    commit.write.mode("overwrite").json(f"{state_path}/commits/seq={seq + 1}")
    # readers of the commit before this one may still be under way; of older ones there are none
    for name in merged:
        remove_dir(spark, f"{state_path}/delta/{name}")
    used = {*bases.values(), *now.values()}
    for name in list_dir(spark, f"{state_path}/base"):
        if int(name.split("=")[1]) not in used:
            remove_dir(spark, f"{state_path}/base/{name}")
    for name in list_dir(spark, f"{state_path}/commits"):
        if int(name.split("=")[1]) < seq:
            remove_dir(spark, f"{state_path}/commits/{name}")


def current_metrics(
    spark: SparkSession,
    state_path: str,
    heartbeat_interval_ms: int = HEARTBEAT_INTERVAL_MS,
    min_snapshots: int = 1,
    by_date: bool = False,
) -> DataFrame:
    """Session metrics of everything the stream has seen."""
    return finalize(merge_partials(read_state(spark, state_path), by_date=by_date), heartbeat_interval_ms, min_snapshots)


class SessionSink:
    """foreachBatch function: stores a batch's partials and publishes the sessions it touched.

    The table lies by ``event_date`` and ``bucket``. A batch's buckets are merged from the state, and their
    partitions under every date that the batch's sessions have heartbeats of, which a session's row can stand under, are
    written anew: valid sessions in the table, those out of range in ``<output>_rejected`` with reasons. Nothing is
    read from the table, so a publication broken off is put right by the next one. With ``publish_every`` n that
    happens once in n batches; ``flush`` publishes what is left. Other ``partition_by`` columns are possible; then rows
    are replaced in the table as it stands. ``generation`` open deltas make a compaction; the number may change at any
    restart. ``buckets`` counts for a state that begins; a later number has no effect.
    """

    def __init__(
        self,
        output_path: str,
        state_path: str,
        heartbeat_interval_ms: int = HEARTBEAT_INTERVAL_MS,
        fmt: str = "parquet",
        generation: int = 20,
        checkpoint_path: str | None = None,
        by_date: bool = False,
        min_snapshots: int = 1,
        partition_by: Sequence[str] = ("event_date",),
        labels: Sequence[str] = OBSERVED_LABELS,
        publish_every: int = 1,
        buckets: int = BUCKETS,
    ):
        self.output, self.state, self.checkpoint = output_path.rstrip("/"), state_path.rstrip("/"), checkpoint_path
        self.interval, self.fmt, self.generation, self.publish_every = heartbeat_interval_ms, fmt, generation, publish_every
        self.by_date, self.min_snapshots, self.partition_by, self.labels = by_date, min_snapshots, partition_by, labels
        self.buckets = buckets
        self.query: str | None = None
        self.unpublished: list[str] | None = None

    def _query(self, spark: SparkSession) -> str:
        """The identity Spark gave to the checkpoint."""
        if self.query is None:
            self.query = "direct" if self.checkpoint is None else query_id(spark, self.checkpoint)
        return self.query

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            name = f"{self._query(spark)}-{batch_id}"
            if self.unpublished is None:  # after a start whatever is open may not have been published
                self.unpublished = [x for x in open_deltas(spark, self.state) if x != name] if self.publish_every > 1 else []
            if batch.isEmpty() or name in last_commit(spark, self.state)[2]:
                return
            if len([x for x in open_deltas(spark, self.state) if x != name]) >= self.generation:
                self.flush(spark)
                # a batch that is replayed was not committed, so its earlier delta must not become part of a base
                remove_dir(spark, f"{self.state}/delta/{name}")
                compact_state(spark, self.state)
            usable, clockless = split_clocks(batch)
            write_delta(session_partials(usable, self.labels), self.state, name, self.buckets)
            as_quarantine(clockless).write.mode("overwrite").json(f"{self.state}/quarantine/{name}")
            self.unpublished = [*(x for x in self.unpublished if x != name), name]
            if len(self.unpublished) >= self.publish_every:
                self.flush(spark)
        finally:
            batch.unpersist()

    def flush(self, spark: SparkSession) -> None:
        """Publish the sessions of the batches stored since the last time; of all open ones right after a start."""
        if self.unpublished is None:
            self.unpublished = open_deltas(spark, self.state)
        if not self.unpublished:
            return
        paths = _delta_paths(spark, self.state, self.unpublished)
        touched = {int(p.rsplit("=", 1)[1]) for p in paths}
        changed = _partials(spark, paths)
        rows = read_state(spark, self.state, touched)
        keys = [*KEYS, "eventDate"] if self.by_date else KEYS
        sessions = changed.select(*keys).distinct()
        if tuple(self.partition_by) == ("event_date",):
            # dates, of which a batch touches few, come to the driver
            seen = changed if self.by_date else rows.join(sessions, on=KEYS, how="left_semi")
            days = [row.eventDate for row in seen.select("eventDate").distinct().toLocalIterator()]
            self._publish(rows, touched, days, bucket_count(spark, self.state))
        else:
            merged = merge_partials(rows.join(sessions, on=keys, how="left_semi"), by_date=self.by_date)
            valid, rejected = validate_metrics(finalize(merged, self.interval, self.min_snapshots))
            names = METRIC_KEYS if self.by_date else SESSION_COLUMNS
            replace_sessions(spark, rejected, sessions.toDF(*names), f"{self.output}_rejected", "json", keys=names)
            replace_sessions(spark, valid, sessions.toDF(*names), self.output, self.fmt, self.partition_by, names)
        self.unpublished = []

    def _publish(self, rows: DataFrame, touched: set[int], days: list, buckets: int) -> None:
        """Writes the partitions of some buckets and dates anew, and removes those that have no row any more."""
        of_days = F.col("event_date").isin([d for d in days if d is not None]) | F.lit(None in days) & F.col("event_date").isNull()
        if self.by_date:
            rows = rows.filter(F.col("eventDate").isin([d for d in days if d is not None]) | F.lit(None in days) & F.col("eventDate").isNull())
        metrics = finalize(merge_partials(rows, by_date=self.by_date), self.interval, self.min_snapshots).filter(of_days)
        metrics = metrics.withColumn("bucket", bucket_of(buckets, "customer_id", "content_id")).persist()
        try:
            valid, rejected = validate_metrics(metrics)
            for part, path, fmt in ((rejected, f"{self.output}_rejected", "json"), (valid, self.output, self.fmt)):
                replace_partitions(part, path, fmt, ("event_date", "bucket"), [(d, b) for d in days for b in sorted(touched)])
        finally:
            metrics.unpersist()


def microbatch_sink(output_path: str, state_path: str, *args, **kw) -> SessionSink:
    return SessionSink(output_path, state_path, *args, **kw)


def start_sessions(
    stream: DataFrame,
    output_path: str,
    checkpoint_path: str,
    state_path: str | None = None,
    trigger_interval: str | None = "30 seconds",
    heartbeat_interval_ms: int = HEARTBEAT_INTERVAL_MS,
    fmt: str = "parquet",
    generation: int = 20,
    **kw,
) -> StreamingQuery:
    """Session metrics, correct across micro-batches; no trigger drains the source once. More options: SessionSink."""
    state = state_path or f"{output_path.rstrip('/')}_state"
    sink = microbatch_sink(output_path, state, heartbeat_interval_ms, fmt, generation, checkpoint_path, **kw)
    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint_path)
    if trigger_interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger_interval).start()


def run_streaming(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    checkpoint_path: str,
    trigger_interval: str | None = "30 seconds",
    heartbeat_ms: int = HEARTBEAT_INTERVAL_MS,
    fmt: str = "parquet",
    state_path: str | None = None,
    input_fmt: str = "parquet",
    payload: bool = False,
    dedup: bool = False,
    **kw,
) -> None:
    """Heartbeat table, or payload table, to metrics table, until stopped; without a trigger until the table is read."""
    if payload:
        raw = spark.readStream.format(input_fmt).schema(PAYLOAD_ROW).load(input_path)
        stream = split_decoded(decode_payload(raw))[0]
    else:
        stream = stream_telemetry(spark, input_path, input_fmt)
    start_sessions(
        dedup_stream(stream) if dedup else stream, output_path, checkpoint_path, state_path, trigger_interval, heartbeat_ms, fmt, **kw
    ).awaitTermination()
    if kw.get("publish_every", 1) > 1:
        SessionSink(output_path, state_path or f"{output_path.rstrip('/')}_state", heartbeat_ms, fmt, **kw).flush(spark)


def microbatch_metrics(batch: DataFrame, heartbeat_interval_ms: int = HEARTBEAT_INTERVAL_MS) -> DataFrame:
    """Metrics of one micro-batch alone: the batch function as it is."""
    return compute_metrics(batch, heartbeat_interval_ms, by_date=True)


def stream_sessions(stream: DataFrame, heartbeat_interval_ms: int = HEARTBEAT_INTERVAL_MS) -> DataFrame:
    """Stateful form for ``update`` output: running totals and ratios per session, without labels."""
    return with_session_ratios(session_totals(project_flat(stream)), heartbeat_interval_ms)


def stream_quality(stream: DataFrame) -> DataFrame:
    """Stateful form for ``update`` output: running bytes per session and label."""
    return quality_bytes(stream)


def stream_window_metrics(
    stream: DataFrame, duration: str = "30 seconds", watermark: str = "1 minute"
) -> DataFrame:
    """Event-time windows per customer's content with a watermark; heartbeats later than it are dropped."""
    rows = stream.selectExpr(
        f"{S.session_key('customerId')} as customerId",
        f"{S.session_key('contentId')} as contentId",
        f"timestamp_millis({S.server_time(SERVER)}) as server_time",
        f"{S.or_zero('player.bufferings')} as bufferings",
        f"{S.or_zero('player.bufferingTime')} as buffering_ms",
        f"{S.received_bytes('totalDistribution')} as received_bytes",
    ).withWatermark("server_time", watermark)
    out = rows.groupBy(F.window("server_time", duration).alias("w"), "customerId", "contentId").agg(*exprs(*WINDOW_SUMS))
    return out.selectExpr("customerId", "contentId", "unix_millis(w.start) as window_start_ms", *out.columns[3:])
