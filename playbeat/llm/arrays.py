"""Vectorised text helpers for Arrow batches: words, hashes and slices of byte buffers.

Texts stay one byte buffer with offsets; words are index arrays into it. Null texts count as empty.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; one longer text makes a slice of its own.
SLICE_BYTES = 2 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[int, np.ndarray] = {}


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The batch function, giving memory back at the end of the task: workers live on, and allocators keep what was freed."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return wrapped


def byte_set(spec: bytes) -> np.ndarray:
    """Lookup table of 256 flags with the given bytes set."""
    table = np.zeros(256, bool)
    table[np.frombuffer(spec, np.uint8)] = True
    return table


#: The ASCII white space that separates words.
WHITE = byte_set(b" \t\n\r\x0b\x0c")


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and int64 offsets, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)):
        column = column.cast(pa.large_string())
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if len(offsets) == 0:
        offsets = np.zeros(1, np.int64)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have about `limit` bytes together."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, min(end, n)
        at = min(end, n)


def word_bounds(buf: np.ndarray, offsets: np.ndarray, separator: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the first word of each text (one entry more than texts)."""
    word = ~separator[buf]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    some = offsets[1:] > offsets[:-1]
    begin, end = offsets[:-1][some], offsets[1:][some] - 1
    first[begin], last[end] = word[begin], word[end]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def powers(n: int, base: np.uint64) -> np.ndarray:
    known = _POWERS.get(int(base))
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 16), base, np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if n <= 16 << 20:
            _POWERS[int(base)] = known
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of any ranges of a sequence of values, from prefix sums modulo 2**64."""

    def __init__(self, values: np.ndarray):
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(len(values), BASE), out=self.sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        back = powers(len(self.sums), INVERSE)
        return mix((self.sums[ends] - self.sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 1 << 19) -> np.ndarray:
    """Hashes of words that stand in order, from prefix sums over about `block` bytes at once."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + block, "right")))
        lo, hi = starts[at], ends[to - 1]
        out[at:to] = Rolling(buf[lo:hi]).hashes(starts[at:to] - lo, ends[at:to] - lo)
        at = to
    return out


def gather(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The given ranges one after another, and their offsets."""
    sizes = ends - starts
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    index = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    return buf[index], offsets


def spaced_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All words, each followed by one space, and the offset of every word."""
    sizes = ends - starts + 1
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    out = np.full(offsets[-1], 32, np.uint8)
    index = np.ones(offsets[-1], bool)
    index[offsets[1:] - 1] = False
    source = np.zeros(len(buf) + 1, np.int8)
    source[starts] += 1
    source[ends] -= 1
    out[index] = buf[np.cumsum(source[:-1], dtype=np.int8).astype(bool)]
    return out, offsets


def same_ranges(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether ranges of equal size hold equal bytes."""
    same = np.ones(len(sizes), bool)
    for lo, hi in slices(np.concatenate([[0], np.cumsum(sizes)]), 8 << 20):
        left, offsets = gather(a, a_starts[lo:hi], a_starts[lo:hi] + sizes[lo:hi])
        right, _ = gather(b, b_starts[lo:hi], b_starts[lo:hi] + sizes[lo:hi])
        bad = np.flatnonzero(left != right)
        same[lo + np.unique(np.searchsorted(offsets, bad, "right") - 1)] = False
    return same


def string_array(buf: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Arrow strings over a byte buffer."""
    if offsets[-1] >= 1 << 31:
        kind, offsets = pa.large_string(), offsets.astype(np.int64)
    else:
        kind, offsets = pa.string(), offsets.astype(np.int32)
    return pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(buf.tobytes())])


def whole_runs(batches: Iterator[pa.RecordBatch], key: Callable[[pa.RecordBatch], np.ndarray], rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Joins batches sorted by a long key so that no run of equal keys is cut; at least `rows` rows where there are more."""
    kept: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        k = key(batch)
        if kept and key(kept[-1])[-1] == k[0] or count < rows:
            other = np.flatnonzero(k != k[-1])
            cut = int(other[-1]) + 1 if len(other) and count + batch.num_rows >= rows else 0
            if cut == 0:
                kept.append(batch)
                count += batch.num_rows
                continue
            yield _joined([*kept, batch.slice(0, cut)])
            kept, count = [batch.slice(cut)], batch.num_rows - cut
        else:
            yield _joined(kept)
            kept, count = [batch], batch.num_rows
    if kept:
        yield _joined(kept)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.concat_batches(batches)
