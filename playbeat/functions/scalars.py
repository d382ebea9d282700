"""Null-safe scalar expressions of the telemetry model, as SQL text for ``selectExpr`` and ``expr``.

Text keeps plan building cheap: a projection is one call into the JVM, not one per operator in it.
"""

from __future__ import annotations

DAY_MS = 86_400_000
LONG_MAX = 2**63 - 1
MAX_MS = 253_402_300_799_999  # end of the year 9999
EPOCH = "date'1970-01-01'"


def or_zero(x: str) -> str:
    """Missing counts are zero, and are summed as long."""
    return f"coalesce(cast({x} as bigint), 0L)"


def session_key(x: str) -> str:
    """A missing identifier is the empty string, so that it groups and joins like any other."""
    return f"coalesce({x}, '')"


def server_time(server: str) -> str:
    return or_zero(server)


def agent_time(agent: str, server: str) -> str:
    """Agent clock; missing or 0 falls back to the server clock of the same heartbeat."""
    return f"coalesce(nullif({agent}, 0L), {server_time(server)})"


def source_bytes(dist: str) -> str:
    return or_zero(f"{dist}.sourceTraffic.receivedData")


def p2p_bytes(dist: str) -> str:
    return or_zero(f"{dist}.p2pTraffic.receivedData")


def held_add(a: str, b: str) -> str:
    """Sum of two longs, held at the largest one where it overflows; the session checks know that value."""
    return f"coalesce(try_add({a}, {b}), {LONG_MAX}L)"


def held_sum(x: str) -> str:
    """Sum over a group, held at the largest long where it overflows, null where there is nothing to sum."""
    return f"coalesce(try_sum({x}), if(count({x}) > 0, {LONG_MAX}L, null))"


def received_bytes(dist: str) -> str:
    return held_add(source_bytes(dist), p2p_bytes(dist))


def safe_ratio(num: str, den: str, default: str = "0D") -> str:
    """num / den as double where den is positive, else the default (ANSI division by zero raises)."""
    return f"if(({den}) > 0, cast({num} as double) / cast({den} as double), {default})"


def capped_ratio(num: str, den: str) -> str:
    return f"least(1D, {safe_ratio(num, den)})"


def epoch_date(ms: str) -> str:
    """UTC calendar day of epoch milliseconds, by arithmetic: independent of the session time zone.

    Null outside the years 1970 to 9999.
    """
    return f"date_add({EPOCH}, if({ms} between 0 and {MAX_MS}, cast({ms} div {DAY_MS} as int), null))"


def event_date(day: str, server: str) -> str:
    """The partition date; without one the day of the server time, and the epoch as a last resort."""
    return f"coalesce({day}, {epoch_date(server_time(server))}, {EPOCH})"


def quality_label(height: str, level: str) -> str:
    """'1080p' from the height, 'level_3' where the height is missing or 0, null without a level."""
    return (
        f"case when {height} > 0 then concat({height}, 'p') "
        f"when {level} is not null then concat('level_', {level}) end"
    )


def text_or_empty(x: str) -> str:
    return f"coalesce(cast({x} as string), '')"


def strict_long(text: str) -> str:
    """Integer from text: '5' and '1.0' pass, '1.5' and 'x' give null."""
    whole = f"try_cast({text} as double) = floor(try_cast({text} as double))"
    return (
        f"coalesce(try_cast({text} as bigint), "
        f"if({whole}, try_cast(try_cast({text} as decimal(38,6)) as bigint), null))"
    )
