"""First and last value of a group by server time, with aggregation buffers a hash aggregate can hold.

``min_by(value, struct(server, value))`` would need a struct in the aggregation buffer, and Spark then
sorts every input split before it can combine. Here the pair (server, value) is packed into one long:
the value is stored as its distance from a base that follows from the server time. Pairs that do not
fit (server outside 0..2^42, distance outside 2^20) take a decimal key instead, which is null - and so
costs next to nothing - on ordinary rows. Both ways give the smaller (larger) pair exactly, for any long
value and server times within 9 * 10^17 of the epoch; server times beyond that rank as equal.
"""

from __future__ import annotations

from collections.abc import Callable

WIDTH = 21
HALF = 1 << (WIDTH - 1)
MASK = (1 << WIDTH) - 1
MAX_SERVER = (1 << 42) - 1
MOST = 899_999_999_999_999_999  # of a server time in the decimal key, so that key and value fit in 38 digits
SHIFT = "100000000000000000000BD"  # more than the span of values that share one server time


class ServerOrdered:
    """First/last ``value`` by (server, value); ``base`` maps a server time to the expected value."""

    def __init__(self, name: str, server: str, value: str, base: Callable[[str], str] = lambda s: s):
        self.name, self.server, self.value, self.base = name, server, value, base

    def columns(self) -> list[str]:
        """Per-row columns to select before the aggregate."""
        n, s, v, base = self.name, self.server, self.value, self.base(self.server)
        near = (
            f"coalesce({s} between 0 and {MAX_SERVER} "
            f"and try_subtract({v}, {base}) between -{HALF} and {HALF - 1}, false)"
        )
        held = f"cast(greatest(least({s}, {MOST}L), -{MOST}L) as decimal(18,0))"
        far_key = f"cast({held} * {SHIFT} as decimal(38,0)) + cast({v} as decimal(19,0))"
        return [
            f"if({near}, shiftleft({s}, {WIDTH}) + ({v} - {base}) + {HALF}L, null) as {n}_near",
            f"if({near}, null, {s}) as {n}_far_server",
            f"if({near}, null, {v}) as {n}_far",
            f"if({near}, null, {far_key}) as {n}_far_key",
        ]

    def aggregates(self, first: bool = True, last: bool = True) -> list[str]:
        n = self.name
        ends = ([("first", "min")] if first else []) + ([("last", "max")] if last else [])
        return [
            c
            for end, extreme in ends
            for c in (
                f"{extreme}({n}_near) as {n}_{end}_near",
                f"{extreme}({n}_far_server) as {n}_{end}_far_server",
                f"{extreme}_by({n}_far, {n}_far_key) as {n}_{end}_far",
            )
        ]

    def _pick(self, end: str, before: str) -> str:
        near, far_server, far = (f"{self.name}_{end}_{c}" for c in ("near", "far_server", "far"))
        server = f"shiftright({near}, {WIDTH})"
        value = f"(({near} & {MASK}L) - {HALF}L + {self.base(server)})"
        far_wins = f"{far_server} {before} {server} or ({far_server} = {server} and {far} {before} {value})"
        return f"if({near} is null or coalesce({far_wins}, false), {far}, {value})"

    def first(self) -> str:
        return self._pick("first", "<")

    def last(self) -> str:
        return self._pick("last", ">")
