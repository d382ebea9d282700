"""Windows of a stream under a watermark that lose no heartbeat: late ones go to a late output.

    <output>/batch=<query>-<batch>/kind=closed   windows that the watermark passed in this micro-batch, each once
    <output>/batch=<query>-<batch>/kind=late     sums of heartbeats whose window had been closed before
    <output>/batch=<query>-<batch>/kind=open     windows under way, kept for the newest two micro-batches only
    <output>/_commits/seq=K                      the name of a completed micro-batch and the watermark after it

The watermark is the one a watermarked aggregate has: the latest server time of all micro-batches less the delay. A
window is closed by the micro-batch that takes the watermark to its end, as if an empty one came after each, and a
heartbeat is late when its window was closed by the micro-batches before. What is written are sums, which add up: closed and late rows together are the windows of all
heartbeats. Nothing is held in memory between micro-batches; the open windows are what lies within the delay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from playbeat.functions.scalars import LONG_MAX
from playbeat.operators.insights import window_metrics
from playbeat.operators.sessions import exprs
from playbeat.schema import HEARTBEAT_INTERVAL_MS
from playbeat.session import completed_dirs, list_dir, query_id, remove_dir

WINDOW_KEYS = ["customerId", "contentId", "window_start_ms"]
SUMMED = ["heartbeats", "heartbeats_with_buffering", "bufferings", "buffering_ms", "received_bytes"]
WINDOWS = "customerId string, contentId string, " + ", ".join(f"{c} bigint" for c in ["window_start_ms", *SUMMED])
COMMIT = "name string, watermark_ms bigint"


def merge_windows(rows: DataFrame) -> DataFrame:
    """Sums of the same window added up; null where none of them has a value, as in the batch."""
    return rows.groupBy(*WINDOW_KEYS).agg(*exprs(*[f"sum({c}) as {c}" for c in SUMMED]))


def last_window_commit(spark: SparkSession, output_path: str) -> tuple[int, str | None, int | None]:
    """(number, micro-batch, watermark) of the newest completed micro-batch; -1 before the first."""
    numbers = [int(x.split("=")[1]) for x in completed_dirs(spark, f"{output_path}/_commits", "seq=*")]
    if not numbers:
        return -1, None, None
    row = spark.read.schema(COMMIT).json(f"{output_path}/_commits/seq={max(numbers)}").first()
    return max(numbers), row.name, row.watermark_ms


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(WINDOWS).parquet(path) if list_dir(spark, path) else spark.createDataFrame([], WINDOWS)


def read_windows(spark: SparkSession, output_path: str, *kinds: str) -> DataFrame:
    """Rows of some kinds, ``closed`` and ``late`` by default; an interrupted micro-batch counts once it is completed.

    One window has one closed row at most, and one late row per micro-batch that had late heartbeats of it.
    """
    out = output_path.rstrip("/")
    names = completed_dirs(spark, out, "batch=*")
    if not names:
        return spark.createDataFrame([], f"{WINDOWS}, batch string, kind string")
    table = spark.read.option("basePath", out).schema(f"{WINDOWS}, batch string, kind string")
    return table.parquet(*[f"{out}/{x}" for x in names]).filter(F.col("kind").isin(*(kinds or ("closed", "late"))))


def all_windows(spark: SparkSession, output_path: str) -> DataFrame:
    """Windows of every heartbeat so far: closed rows, late ones merged into them, and the windows under way."""
    out = output_path.rstrip("/")
    _, name, _ = last_window_commit(spark, out)
    under_way = _read(spark, f"{out}/batch={name}/kind=open")
    return merge_windows(read_windows(spark, out).drop("batch", "kind").unionByName(under_way))


class WindowSink:
    """foreachBatch function: closes windows behind the watermark and routes late heartbeats.

    A micro-batch is one write; its commit comes after it. A replay of a micro-batch that has a commit does nothing, of
    one without writes its folder anew. ``delay_ms`` may change at a restart: the watermark never goes back.
    """

    def __init__(self, output_path: str, checkpoint_path: str | None, delay_ms: int = 60_000, window_ms: int = HEARTBEAT_INTERVAL_MS):
        self.output, self.checkpoint, self.delay, self.window = output_path.rstrip("/"), checkpoint_path, delay_ms, window_ms
        self.query: str | None = None

    def _over(self, watermark: int) -> str:
        """Whether the watermark has reached a window's end; an end beyond a long is never reached."""
        return f"coalesce(try_add(window_start_ms, {self.window}L) <= {watermark}L, false)"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if self.query is None:
            self.query = "direct" if self.checkpoint is None else query_id(spark, self.checkpoint)
        name = f"{self.query}-{batch_id}"
        seq, before, passed = last_window_commit(spark, self.output)
        if name == before:
            return
        late = "false" if passed is None else self._over(passed)
        # sums of a batch are far fewer than its rows: one pass over the source, then these are read again
        part = window_metrics(batch, self.window, latest=True).persist()
        try:
            newest = part.agg(F.max("latest_ms")).first()[0]
            if newest is None:
                return
            watermark = max(newest - self.delay, -LONG_MAX if passed is None else passed)
            rows = part.drop("latest_ms")
            due = merge_windows(rows.filter(f"not {late}").unionByName(_read(spark, f"{self.output}/batch={before}/kind=open")))
            closed = f"if({self._over(watermark)}, 'closed', 'open') as kind"
            both = due.selectExpr("*", closed).unionByName(rows.filter(late).selectExpr("*", "'late' as kind"))
            both.write.mode("overwrite").partitionBy("kind").parquet(f"{self.output}/batch={name}")
        finally:
            part.unpersist()
        commit = spark.createDataFrame([(name, watermark)], COMMIT).coalesce(1)
        commit.write.mode("overwrite").json(f"{self.output}/_commits/seq={seq + 1}")
        self._forget(spark, seq)

    def _forget(self, spark: SparkSession, seq: int) -> None:
        """Open windows and commits of micro-batches before the one before: a reader may still hold that one."""
        for old in list_dir(spark, f"{self.output}/_commits"):
            if int(old.split("=")[1]) < seq:
                path = f"{self.output}/_commits/{old}"
                row = spark.read.schema(COMMIT).json(path).first()
                if row is not None:
                    remove_dir(spark, f"{self.output}/batch={row.name}/kind=open")
                remove_dir(spark, path)


def start_windows(
    stream: DataFrame,
    output_path: str,
    checkpoint_path: str,
    delay_ms: int = 60_000,
    trigger_interval: str | None = "30 seconds",
    window_ms: int = HEARTBEAT_INTERVAL_MS,
) -> StreamingQuery:
    """Windows of a stream of heartbeats, late ones kept; no trigger drains the source once. Read with `all_windows`."""
    sink = WindowSink(output_path, checkpoint_path, delay_ms, window_ms)
    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint_path)
    if trigger_interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger_interval).start()
