"""Fleet-level summaries of session metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from playbeat.functions.scalars import safe_ratio
from playbeat.operators.sessions import exprs


def fleet_figures(where: str = "true") -> list[str]:
    """Aggregates that the fleet summaries are made from, over the rows that meet the condition."""
    return [
        f"count_if({where}) as viewers",
        f"count_if({where} and total_buffering_events > 0) as viewers_with_buffering",
        f"avg(if({where}, buffering_ratio, null)) as avg_buffering_ratio",
        f"avg(if({where}, p2p_ratio, null)) as avg_p2p_ratio",
    ]


def summary_of(figures: DataFrame) -> DataFrame:
    share = safe_ratio("viewers_with_buffering", "viewers")
    return figures.selectExpr(
        "viewers", "viewers_with_buffering", f"{share} * 100 as buffering_viewers_pct", "avg_buffering_ratio"
    )


def summary_pct_of(figures: DataFrame, places: int = 2) -> DataFrame:
    return figures.selectExpr(
        "viewers as total_viewers",
        f"round(avg_buffering_ratio * 100, {places}) as avg_buf_ratio_pct",
        f"round(avg_p2p_ratio * 100, {places}) as avg_p2p_pct",
    )


def fleet_summary(metrics: DataFrame) -> DataFrame:
    """Viewers, viewers that buffered with their share, and the mean buffering ratio."""
    return summary_of(metrics.agg(*exprs(*fleet_figures())))


def fleet_summary_pct(metrics: DataFrame, places: int = 2) -> DataFrame:
    """Viewers with mean buffering and peer-to-peer ratios in per cent."""
    return summary_pct_of(metrics.agg(*exprs(*fleet_figures())), places)


def dominant_distribution(metrics: DataFrame, include_missing: bool = False) -> DataFrame:
    """Sessions per dominant label, most frequent first; sessions without a label on request."""
    rows = metrics if include_missing else metrics.filter("dominant_quality is not null and dominant_quality <> ''")
    return rows.groupBy("dominant_quality").count().orderBy(F.desc("count"), "dominant_quality")


def label_counts(metrics: DataFrame) -> DataFrame:
    """Per label the sessions that have it in their breakdown and those it dominates, from one aggregate.

    (quality_label, sessions, dominated); the null label counts the sessions without a dominant one.
    """
    held = "transform(quality_breakdown, q -> struct(q.quality_label as quality_label, 1L as held, 0L as dominant))"
    led = "array(struct(dominant_quality as quality_label, 0L as held, 1L as dominant))"
    rows = metrics.selectExpr(f"inline(concat(coalesce({held}, array()), {led}))")
    return rows.groupBy("quality_label").agg(*exprs("sum(held) as sessions", "sum(dominant) as dominated"))
