"""Removal of repeated heartbeats."""

from __future__ import annotations

from pyspark.sql import DataFrame

from playbeat.functions.scalars import session_key
from playbeat.operators.sessions import SERVER, key_columns
from playbeat.schema import KEYS

AGENT = "timestampInfo.agent"
# Which clock tells heartbeats of a session apart, and its time: the server's, else the player's.
CLOCK = f"case when {SERVER} is not null then 's' when {AGENT} is not null then 'a' end"
TIME = f"coalesce({SERVER}, {AGENT})"

# Among differing copies the smallest by these stays. Two longs decide nearly always; the rest makes the order total.
COPY_ORDER = (
    f"{AGENT}, xxhash64(eventDate, player, totalDistribution), eventDate, player, totalDistribution, "
    "array_sort(map_entries(qualityDistribution))"
)


def dedup_heartbeats(df: DataFrame) -> DataFrame:
    """One heartbeat per session and server time, whichever order the rows arrive in.

    A heartbeat without a server time is known by its agent time instead; without either nothing tells it
    from another, and it stays. Copies are cut to one per input split before the shuffle (a window group
    limit), so a heartbeat repeated a billion times does not meet in one task.
    """
    marked = df.selectExpr("*", f"{CLOCK} as _clock", f"if({TIME} is null, monotonically_increasing_id(), {TIME}) as _at")
    keys = ", ".join([*[session_key(k) for k in KEYS], "_clock", "_at"])
    ranked = marked.selectExpr("*", f"row_number() over (partition by {keys} order by {COPY_ORDER}) as _copy")
    return ranked.filter("_copy = 1").drop("_copy", "_clock", "_at")


def dedup_stream(df: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Streaming form, with state for the length of the watermark.

    Repeats within the watermark are dropped. A heartbeat that arrives later than the watermark is dropped
    too, repeated or not, as its state is gone: choose a watermark beyond the latest arrival that counts.
    Heartbeats without any clock pass.
    """
    timed = df.selectExpr(
        *[c for c in df.columns if c not in KEYS],
        *key_columns(),
        f"{CLOCK} as _clock",
        f"{TIME} as _at",
        f"timestamp_millis({TIME}) as _time",
    )
    known = timed.filter("_at is not null").withWatermark("_time", watermark)
    kept = known.dropDuplicatesWithinWatermark([*KEYS, "_clock", "_at"]).select(*df.columns)
    return kept.unionAll(timed.filter("_at is null").select(*df.columns))
