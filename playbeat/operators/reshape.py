"""Flat form of the session metrics: one pair of columns per quality label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from playbeat.functions.scalars import text_or_empty
from playbeat.operators.quality import breakdown_map
from playbeat.schema import FLAT_COLUMNS


def distinct_labels(metrics: DataFrame) -> DataFrame:
    """All quality labels of the metrics, sorted."""
    labels = metrics.selectExpr("explode(quality_breakdown.quality_label) as quality_label")
    return labels.distinct().orderBy("quality_label")


def flatten_metrics(metrics: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """Scalar columns, then ``quality_bytes_<label>`` and ``quality_pct_<label>`` in label order.

    The values are looked up in each row's own breakdown, so there is no pivot and no shuffle. Without
    ``labels`` the distinct labels are read first: they are the column names of the result.
    """
    if labels is None:
        labels = [row.quality_label for row in distinct_labels(metrics).toLocalIterator()]
    labels = sorted(labels)
    by_label = metrics.selectExpr("*", f"{breakdown_map('quality_breakdown')} as by_label")

    def cell(label: str, field: str, missing: int | float) -> Column:
        return F.coalesce(F.try_element_at("by_label", F.lit(label))[field], F.lit(missing))

    return by_label.select(
        *FLAT_COLUMNS,
        *[cell(x, "received_bytes", 0).alias(f"quality_bytes_{x}") for x in labels],
        *[cell(x, "share_pct", 0.0).alias(f"quality_pct_{x}") for x in labels],
    )


def round_flat(flat: DataFrame) -> DataFrame:
    """The flat file's texts and decimals: ratios to 4 places, mean duration to 1, missing as empty."""
    return flat.withColumns({
        "event_date": F.expr("cast(event_date as string)"),
        "buffering_ratio": F.expr("round(buffering_ratio, 4)"),
        "avg_buffering_duration_ms": F.expr(text_or_empty("round(avg_buffering_duration_ms, 1)")),
        "dominant_quality": F.expr(text_or_empty("dominant_quality")),
        "p2p_ratio": F.expr("round(p2p_ratio, 4)"),
    })
