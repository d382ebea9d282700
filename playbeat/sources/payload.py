"""JSON heartbeat payloads, as a broker topic or a log table delivers them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from playbeat.functions import scalars as S
from playbeat.schema import HEARTBEAT

CORRUPT = "_corrupt_record"
PAYLOAD = T.StructType(HEARTBEAT.fields + [T.StructField(CORRUPT, T.StringType())])


def decode_payload(raw: DataFrame) -> DataFrame:
    """Decode (value, timestamp) rows; the server clock is the receipt time.

    A line that does not parse keeps its text in ``_corrupt_record``. Works on streams as on tables.
    """
    body = F.from_json(F.col("value").cast("string"), PAYLOAD, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    decoded = raw.select(
        body.alias("p"), F.unix_millis(F.col("timestamp").cast("timestamp")).alias("received")
    )
    special = {
        "timestampInfo": "struct(received as server, p.timestampInfo.agent as agent)",
        "eventDate": S.event_date("p.eventDate", "received"),
    }
    fields = [f"{special.get(name, f'p.{name}')} as {name}" for name in HEARTBEAT.fieldNames()]
    return decoded.selectExpr(*fields, f"p.{CORRUPT} as {CORRUPT}")


def split_decoded(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(heartbeats, corrupt lines)."""
    valid = decoded.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return valid, decoded.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def read_topic(spark: SparkSession, servers: str, topic: str = "telemetry-raw", **options: str) -> DataFrame:
    """Streaming (value, timestamp) rows of a broker topic; needs Spark's Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
        .load()
        .select("value", "timestamp")
    )
