"""Bytes, shares and ranks per session and quality label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from playbeat.functions import scalars as S
from playbeat.operators.sessions import SERVER, exprs, key_columns, project_flat, session_keys, session_totals
from playbeat.schema import OBSERVED_LABELS

MOST_BYTES = "order by received_bytes desc, quality_label"


def explode_quality(df: DataFrame, outer: bool = False) -> DataFrame:
    """One row per heartbeat and label; ``outer`` keeps heartbeats without a map as a null label.

    Without ``outer`` the null labels are dropped after an outer explode: from a plain explode Spark
    infers a filter on the map's size below it, which builds a computed map twice.
    """
    rows = df.selectExpr(
        *key_columns(),
        f"{S.event_date('eventDate', SERVER)} as eventDate",
        "explode_outer(qualityDistribution) as (quality_label, dist)",
    )
    return rows if outer else rows.filter("quality_label is not null")


def label_bytes(exploded: DataFrame, by_date: bool = False) -> DataFrame:
    """Received bytes per session and label of exploded rows."""
    rows = exploded.groupBy(*session_keys(by_date), "quality_label")
    return rows.agg(*exprs(f"{S.held_sum(S.received_bytes('dist'))} as received_bytes"))


def quality_bytes(df: DataFrame, by_date: bool = False) -> DataFrame:
    """Received bytes per session and label; heartbeats without a map add nothing."""
    return label_bytes(explode_quality(df), by_date)


def _quoted(label: str) -> str:
    return "'" + label.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _has(label: str) -> str:
    return f"map_contains_key(qualityDistribution, {_quoted(label)})"


def label_sums(labels: Sequence[str]) -> dict[str, str]:
    """Per heartbeat and expected label the bytes as a column, null where the map lacks the label."""
    return {
        f"label_{i}": f"if({_has(x)}, {S.received_bytes(f'qualityDistribution[{_quoted(x)}]')}, null)"
        for i, x in enumerate(labels)
    }


def session_labels(
    df: DataFrame, by_date: bool = False, labels: Sequence[str] = OBSERVED_LABELS
) -> DataFrame:
    """Session totals with ``labels``, the array of (quality_label, received_bytes), in one scan.

    Expected labels are summed as columns of the session aggregate: no explode, and one shuffled row per
    session. Entries of the map with any other label become rows of their own before that aggregate and
    come back as a list per session.
    """
    columns = label_sums(labels)
    unknown = f"e.key not in ({', '.join(map(_quoted, labels))})" if labels else "true"
    entries = (
        f"transform(filter(map_entries(qualityDistribution), e -> {unknown}), "
        f"e -> struct(e.key as label, {S.received_bytes('e.value')} as label_bytes))"
    )
    flat = project_flat(df, *[f"{x} as {name}" for name, x in columns.items()], f"{entries} as entries")
    totals = session_totals(flat, by_date, list(columns), "entries")
    if by_date:
        totals = totals.withColumnRenamed("event_date", "eventDate")
    expected = ", ".join(
        f"struct({_quoted(x)} as quality_label, {name} as received_bytes)" for name, x in zip(columns, labels)
    )
    kind = "array<struct<quality_label:string,received_bytes:bigint>>"
    present = f"filter(cast(array({expected}) as {kind}), x -> x.received_bytes is not null)"
    kept = [c for c in totals.columns if c not in (*columns, "label_list")]
    return totals.selectExpr(*kept, f"concat({present}, cast(label_list as {kind})) as labels")


def share_pct(part: str, total: str) -> str:
    return f"({S.safe_ratio(part, total)} * 100)"


def _session(by_date: bool) -> str:
    return f"partition by {', '.join(session_keys(by_date))}"


def quality_share(per_label: DataFrame, by_date: bool = False) -> DataFrame:
    """Adds the session's bytes and each label's unrounded share of them."""
    totals = per_label.selectExpr("*", f"sum(received_bytes) over ({_session(by_date)}) as session_bytes")
    return totals.selectExpr("*", f"{share_pct('received_bytes', 'session_bytes')} as share_pct")


def quality_rank(per_label: DataFrame, by_date: bool = False) -> DataFrame:
    """Adds ``position`` (ties broken by label) and ``quality_rank`` (ties share a rank)."""
    return per_label.selectExpr(
        "*",
        f"row_number() over ({_session(by_date)} {MOST_BYTES}) as position",
        f"rank() over ({_session(by_date)} order by received_bytes desc) as quality_rank",
    )


def dominant_quality(per_label: DataFrame, by_date: bool = False) -> DataFrame:
    """Exactly one label per session: most bytes, then the smaller label."""
    ranked = per_label.selectExpr("*", f"row_number() over ({_session(by_date)} {MOST_BYTES}) as position")
    return ranked.filter("position = 1").selectExpr(*session_keys(by_date), "quality_label as dominant_quality")


def breakdown_entries(labels: str, total: str) -> str:
    """Array of (label, bytes, share) from an array of (quality_label, received_bytes), most bytes first."""
    ordered = f"array_sort(transform({labels}, x -> struct(-x.received_bytes as negated, x.quality_label as label)))"
    share = share_pct("-x.negated", total)
    return (
        f"transform({ordered}, x -> struct(x.label as quality_label, -x.negated as received_bytes, "
        f"round({share}, 2) as share_pct))"
    )


def quality_breakdown(per_label: DataFrame, by_date: bool = False) -> DataFrame:
    """One row per session: the ordered breakdown and its first label.

    What is collected per session is its labels, already summed, not its heartbeats.
    """
    keys = session_keys(by_date)
    grouped = per_label.groupBy(*keys).agg(*exprs(
        "collect_list(struct(quality_label, received_bytes)) as labels", "sum(received_bytes) as session_bytes"
    ))
    return with_dominant(grouped, *keys, entries=breakdown_entries("labels", "session_bytes"))


def with_dominant(df: DataFrame, *columns: str, entries: str) -> DataFrame:
    """The breakdown and the label it starts with."""
    rows = df.selectExpr(*columns, f"{entries} as quality_breakdown")
    return rows.selectExpr("*", "try_element_at(quality_breakdown, 1).quality_label as dominant_quality")


def breakdown_map(breakdown: str) -> str:
    """The breakdown as map<label, struct<received_bytes, share_pct>>."""
    return (
        f"map_from_entries(transform({breakdown}, "
        "x -> struct(x.quality_label as key, struct(x.received_bytes, x.share_pct) as value)))"
    )


def quality_map(per_label: DataFrame, by_date: bool = False) -> DataFrame:
    return quality_breakdown(per_label, by_date).selectExpr(
        *session_keys(by_date), f"{breakdown_map('quality_breakdown')} as quality_breakdown"
    )


def quality_metrics(df: DataFrame, by_date: bool = False) -> DataFrame:
    """Breakdown and dominant label per session, straight from heartbeats."""
    return quality_breakdown(quality_bytes(df, by_date), by_date)


def join_dominant_breakdown(per_label: DataFrame, by_date: bool = False) -> DataFrame:
    """Dominant label next to the map view, per session; the breakdown already holds both, so there is no join."""
    rows = quality_breakdown(per_label, by_date).filter("dominant_quality is not null")
    return rows.selectExpr(
        *session_keys(by_date), "dominant_quality", f"{breakdown_map('quality_breakdown')} as quality_breakdown"
    )
