"""Helpers for the per-quality traffic map, as SQL text."""

from __future__ import annotations

from playbeat.functions.scalars import held_add


def pairs_to_map(pairs: str) -> str:
    """Map from an array of (key, value) structs; the last of equal keys wins, an empty array is null."""
    later = f"slice({pairs}, i + 2, size({pairs}))"
    return (
        f"if(size({pairs}) > 0, "
        f"map_from_entries(filter({pairs}, (e, i) -> not exists({later}, x -> x.key = e.key))), null)"
    )


def map_total(quality: str, field: str, kind: str = "bigint") -> str:
    """Sum of one sourceTraffic counter over all labels."""
    zero = f"cast(0 as {kind})"
    return (
        f"aggregate(coalesce(map_values({quality}), array()), {zero}, "
        f"(acc, dist) -> acc + coalesce(cast(dist.sourceTraffic.{field} as {kind}), {zero}))"
    )


def long_total(values: str) -> str:
    """Sum of an array of longs, held at the largest one where it overflows."""
    return f"aggregate({values}, 0L, (acc, v) -> {held_add('acc', 'v')})"
