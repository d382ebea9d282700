"""Removal of word windows that an earlier document already has, by super-k-mer partitioning.

A window is `window` consecutive words of one document; a document with a smaller id is the earlier one. Consecutive
windows that share a minimiser (the smallest hash of their `minimiser`-word parts) travel as one packed string to the
bucket of that minimiser. Equal windows have equal minimisers, so each bucket sorts and compares its windows alone.
Before the shuffle every task compares its own strings: of equal strings only those of the smallest document travel,
the others are known to be repeats, so a passage that a third of all documents hold arrives about once per task.
Minimisers with many windows, as those of a frequent part with ever other neighbours, are found by counting them in a
sample of the documents; their windows travel singly and are dealt over several buckets by the window's own hash.
Equal windows still meet, whatever the sample says.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playbeat.llm import arrays as A

#: Texts compared with one another before the shuffle.
TASK_BYTES = 8 << 20
#: Windows of a minimiser above which they are dealt by their own hash, and windows of a bucket on average at most.
SPLIT_ABOVE = 1 << 18
BUCKET_WINDOWS = 1 << 21
#: One document in so many is counted for both.
COUNT_EVERY = 16
STEP = np.uint64(0x9E3779B97F4A7C15)
HEAD = struct.Struct("<qq")


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` consecutive values."""
    out, covered = values, 1
    while covered < width:
        step = min(covered, width - covered)
        out = np.minimum(out[: len(out) - step], out[step:])
        covered += step
    return out


def super_kmers(hashes: np.ndarray, texts: np.ndarray, window: int, minimiser: int) -> tuple[np.ndarray, ...]:
    """First word, number of windows, text and minimiser of each run of windows; `texts` is the first word of each text."""
    none = np.zeros(0, np.int64)
    n = len(hashes) - window + 1
    if n <= 0:
        return none, none, none, none.astype(np.uint64)
    parts = A.Rolling(hashes)
    at = np.arange(len(hashes) - minimiser + 1)
    least = sliding_min(parts.hashes(at, at + minimiser), window - minimiser + 1)
    text = np.repeat(np.arange(len(texts) - 1), np.diff(texts))
    first = np.flatnonzero(text[:n] == text[window - 1 :])
    if not len(first):
        return none, none, none, none.astype(np.uint64)
    new = np.ones(len(first), bool)
    new[1:] = (first[1:] != first[:-1] + 1) | (least[first[1:]] != least[first[:-1]]) | (text[first[1:]] != text[first[:-1]])
    start = np.flatnonzero(new)
    return first[start], np.diff(np.append(start, len(first))), text[first[start]], least[first[start]]


def _pack(doc: np.ndarray, key: np.ndarray, start: np.ndarray, end: np.ndarray, body: np.ndarray) -> bytes:
    """Documents, word spans and the bytes of the words, compressed together; ids go as steps, as they mostly ascend."""
    wide = int(len(end) > 0 and end.max() >= 1 << 31)
    small = np.int64 if wide else np.int32
    parts = [HEAD.pack(wide, len(doc)), np.diff(doc, prepend=0).tobytes(), key.astype(np.int32).tobytes(), start.astype(small).tobytes()]
    raw = b"".join([*parts, (end - start).astype(small).tobytes(), body.tobytes()])
    return zstandard.ZstdCompressor(level=5).compress(raw)


def _unpack(blob: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    """Documents, keys, starts, numbers of words, and the bytes."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    wide, rows = HEAD.unpack_from(raw)
    at, columns = HEAD.size, []
    for kind in (np.int64, np.int32, *[np.int64 if wide else np.int32] * 2):
        columns.append(np.frombuffer(raw, kind, rows, at).astype(np.int64))
        at += columns[-1].size * np.dtype(kind).itemsize
    columns[0] = np.cumsum(columns[0])
    return columns, np.frombuffer(raw, np.uint8, offset=at)


def _spans(doc: np.ndarray, key: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (doc, key, start, end)], names=["doc", "key", "start", "end"])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of TASK_BYTES or a little more."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= TASK_BYTES:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Documents (doc, key, text) as ids, keys, bytes and offsets of about TASK_BYTES of text."""
    for batch in _gathered(batches):
        doc, key = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        buf, offsets = A.text_buffer(batch.column(2))
        for lo, hi in A.slices(offsets, TASK_BYTES):
            yield doc[lo:hi], key[lo:hi], buf[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]


def _minimisers(window: int, minimiser: int):
    """Documents to numbers of windows by minimiser, and of all under null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, buf, offsets in _texts(batches):
            starts, ends, texts = A.word_bounds(buf, offsets)
            _, count, _, least = super_kmers(A.word_hashes(buf, starts, ends), texts, window, minimiser)
            found, own = np.unique(least, return_inverse=True)
            n = np.bincount(own, count, minlength=len(found)).astype(np.int64)
            least = pa.concat_arrays([pa.array(found.view(np.int64)), pa.nulls(1, pa.int64())])
            yield pa.RecordBatch.from_arrays([least, pa.array(np.append(n, n.sum()))], names=["least", "n"])

    return run


def layout(rows: DataFrame, window: int, minimiser: int, least_buckets: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of buckets, the minimisers to be dealt by window in order, and over how many parts each, from a sample of (doc, key, text)."""
    some = rows.where(F.pmod(F.xxhash64("doc", "key"), F.lit(COUNT_EVERY)) == 0)
    counts = some.mapInArrow(A.released(_minimisers(window, minimiser)), "least long, n long").groupBy("least").agg(F.sum("n").alias("n"))
    many = counts.where(F.col("least").isNull() | (F.col("n") * COUNT_EVERY > SPLIT_ABOVE)).collect()
    windows = sum(r.n for r in many if r.least is None) * COUNT_EVERY
    found = np.array([r.least for r in many if r.least is not None], np.int64).view(np.uint64)
    n = np.array([r.n for r in many if r.least is not None], np.int64) * COUNT_EVERY
    order = np.argsort(found)
    return max(least_buckets, -(-windows // BUCKET_WINDOWS)), found[order], -(-n // SPLIT_ABOVE)[order]


def _split(hashes: np.ndarray, window: int, runs: tuple[np.ndarray, ...], hot: np.ndarray, splits: np.ndarray) -> tuple[np.ndarray, ...]:
    """The runs of windows with those of hot minimisers singly, whose minimiser is changed by the window's own hash."""
    first, count, text, least = runs
    at = np.minimum(np.searchsorted(hot, least), len(hot) - 1)
    single = hot[at] == least
    times = np.where(single, count, 1)
    own = np.repeat(np.arange(len(first)), times)
    first = first[own] + np.arange(len(own)) - np.repeat(np.cumsum(times) - times, times)
    single, least = single[own], least[own]
    mark = A.Rolling(hashes).hashes(first[single], first[single] + window)
    least[single] += mark % splits[at[own][single]].astype(np.uint64) * STEP
    return first, np.where(single, 1, count[own]), text[own], least


def _ship(window: int, minimiser: int, buckets: int, hot: np.ndarray | None = None, splits: np.ndarray | None = None):
    """Documents (doc, key, text) to packed strings by bucket; decisions of the task itself have a negative bucket."""

    def rows(doc: np.ndarray, key: np.ndarray, buf: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, bytes]]:
        starts, ends, texts = A.word_bounds(buf, offsets)
        body, at = A.spaced_words(buf, starts, ends)
        hashes = A.word_hashes(buf, starts, ends)
        first, count, text, least = super_kmers(hashes, texts, window, minimiser)
        if not len(first):
            return
        if hot is not None and len(hot):
            first, count, text, least = _split(hashes, window, (first, count, text, least), hot, splits)
        last = first + count + window - 1
        mark = A.Rolling(hashes).hashes(first, last)
        order = np.lexsort((doc[text], mark))
        new = np.ones(len(order), bool)
        new[1:] = mark[order[1:]] != mark[order[:-1]]
        lead = np.empty(len(order), np.int64)
        lead[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        later = np.flatnonzero(doc[text] > doc[text[lead]])
        size = at[last] - at[first]
        later = later[size[later] == size[lead[later]]]
        later = later[A.same_ranges(body, at[first[later]], body, at[first[lead[later]]], size[later])]
        if len(later):
            known, begin, end = text[later], first[later], last[later]
            cut = np.append(True, (known[1:] != known[:-1]) | (begin[1:] > end[:-1]))
            closes = np.append(np.flatnonzero(cut)[1:], len(later)) - 1
            known, begin, end = known[cut], begin[cut], end[closes]
            yield -1 - int(doc[known[0]] % buckets), _pack(doc[known], key[known], begin - texts[known], end - texts[known], body[:0])
        send = np.ones(len(first), bool)
        send[later] = False
        send = np.flatnonzero(send)
        bucket = (least[send] % np.uint64(buckets)).astype(np.int64)
        send = send[np.argsort(bucket, kind="stable")]
        bucket.sort()
        edges = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(send))
        for lo, hi in zip(edges[:-1], edges[1:]):
            part = send[lo:hi]
            words, _ = A.gather(body, at[first[part]], at[last[part]])
            own = text[part]
            yield int(bucket[lo]), _pack(doc[own], key[own], first[part] - texts[own], last[part] - texts[own], words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _texts(batches):
            part = list(rows(*texts))
            if part:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, _ in part], pa.int64()), pa.array([x for _, x in part], pa.binary())], names=["bucket", "packed"]
                )

    return run


def _repeats(blobs: list[bytes], window: int) -> pa.RecordBatch:
    """Word spans of one bucket's windows that also start in a document with a smaller id."""
    parts = [_unpack(b) for b in blobs]
    doc, key, start, size = (np.concatenate([p[0][i] for p in parts]) for i in range(4))
    body = np.concatenate([p[1] for p in parts])
    ends = np.flatnonzero(body == 32)
    begin = np.append(0, ends[:-1] + 1)
    base = np.append(0, np.cumsum(size))
    hashes = A.word_hashes(body, begin, ends)
    count = size - window + 1
    run = np.repeat(np.arange(len(size)), count)
    offset = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
    first = base[run] + offset
    mark = A.Rolling(hashes).hashes(first, first + window)
    owner = doc[run]
    order = np.argsort(mark, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = mark[order[1:]] != mark[order[:-1]]
    groups = np.flatnonzero(new)
    least = np.minimum.reduceat(owner[order], groups)
    group = np.cumsum(new) - 1
    is_least = owner[order] == least[group]
    holder = np.full(len(groups), -1, np.int64)
    holder[group[is_least][::-1]] = order[is_least][::-1]
    lead = np.empty(len(order), np.int64)
    lead[order] = holder[group]
    later = np.flatnonzero(owner > owner[lead])
    length = ends[first + window - 1] - begin[first]
    same = length[later] == length[lead[later]]
    sure = later[same]
    same[same] = A.same_ranges(body, begin[first[sure]], body, begin[first[lead[sure]]], length[sure])
    if not same.all():  # two contents under one hash: settle those groups by their words
        later = np.concatenate([later[same], _settle(np.unique(lead[later[~same]]), lead, owner, body, begin[first], length)])
        later = np.unique(later)
    cut = np.ones(len(later), bool)
    cut[1:] = (run[later[1:]] != run[later[:-1]]) | (offset[later[1:]] > offset[later[:-1]] + window)
    opens = np.flatnonzero(cut)
    if not len(opens):
        return _spans(*[np.zeros(0, np.int64)] * 4)
    closes = np.append(opens[1:], len(later)) - 1
    who = run[later[opens]]
    return _spans(doc[who], key[who], start[who] + offset[later[opens]], start[who] + offset[later[closes]] + window)


def _settle(leads: np.ndarray, lead: np.ndarray, owner: np.ndarray, body: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    found = []
    for one in leads:
        members = np.flatnonzero(lead == one)
        least: dict[bytes, int] = {}
        texts = [body[at[m] : at[m] + length[m]].tobytes() for m in members]
        for text, m in zip(texts, members):
            least[text] = min(least.get(text, owner[m]), owner[m])
        found += [m for text, m in zip(texts, members) if owner[m] > least[text]]
    return np.array(found, np.int64)


def _judge(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None
        for batch in batches:
            for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                if bucket < 0:
                    doc, key, start, size = _unpack(blob.as_py())[0]
                    yield _spans(doc, key, start, start + size)
                    continue
                if bucket != at and held:
                    yield _repeats(held, window)
                    held = []
                at = bucket
                held.append(blob.as_py())
        if held:
            yield _repeats(held, window)

    return run


def _cut(as_is: bool):
    """(text, spans) to (kept_text, n_words, n_removed), after the other columns, which stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _cut_batch(batch, as_is)

    return run


def _cut_batch(batch: pa.RecordBatch, as_is: bool) -> Iterator[pa.RecordBatch]:
    n = batch.num_columns
    whole, all_offsets = A.text_buffer(batch.column(n - 2))
    for lo, hi in A.slices(all_offsets):
        part, offsets = batch.slice(lo, hi - lo), all_offsets[lo : hi + 1] - all_offsets[lo]
        buf = whole[all_offsets[lo] : all_offsets[hi]]
        starts, ends, texts = A.word_bounds(buf, offsets)
        spans = part.column(n - 1)
        inside = spans.flatten()
        owner = np.repeat(np.arange(hi - lo), spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        depth = np.zeros(len(starts) + 1, np.int64)
        if len(owner):
            np.add.at(depth, texts[owner] + inside.field(0).to_numpy(), 1)
            np.add.at(depth, texts[owner] + inside.field(1).to_numpy(), -1)
        stay = np.cumsum(depth[:-1]) == 0
        body, _ = A.spaced_words(buf, starts[stay], ends[stay]) if stay.all() else _some_words(buf, starts[stay], ends[stay])
        left = np.append(0, np.cumsum(stay))[texts]
        sizes = np.append(0, np.cumsum((ends - starts + 1)[stay]))[left]
        opening, close = sizes[:-1], sizes[1:] - (sizes[1:] > sizes[:-1])
        n_words, n_left = np.diff(texts), np.diff(left)
        if as_is:  # texts that lose nothing come from the source
            body, same = np.concatenate([body, buf]), n_words == n_left
            opening = np.where(same, len(body) - len(buf) + offsets[:-1], opening)
            close = np.where(same, len(body) - len(buf) + offsets[1:], close)
        text = A.string_array(*A.gather(body, opening, close))
        if as_is and part.column(n - 2).null_count:
            text = pc.if_else(part.column(n - 2).is_null(), None, text)
        columns = [*part.columns[: n - 2], text, pa.array(n_words), pa.array(n_words - n_left)]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[: n - 2], "kept_text", "n_words", "n_removed"])


def _some_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As spaced_words, where words in between are left out: each word takes the byte after it along, then a space is put there."""
    padded = np.append(buf, np.uint8(32))
    body, offsets = A.gather(padded, starts, ends + 1)
    body[offsets[1:] - 1] = 32
    return body, offsets


def remove_repeated_windows(docs: DataFrame, window: int = 13, minimiser: int = 3, buckets: int | None = None, *, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None, as_is: bool = False) -> DataFrame:
    """One row per input row: (doc_id, the `keep` columns, kept_text, n_words, n_removed).

    Words are runs of bytes other than ASCII white space. A word goes if a window that covers it also starts, with the
    same words, in a document of smaller id; windows are judged on the input. `kept_text` joins the words that stay by
    one space; with `as_is` a text that loses nothing stays as it was, null or not. Null and empty texts have no words and an empty `kept_text`; texts shorter than a window lose nothing.
    A row without an id neither loses words nor makes others lose any. Rows that repeat an id are the same document:
    they do not remove each other's words. Other columns than those in `keep` are ignored.
    Rows of one id are told apart by 32 bits of a text hash. `buckets` is the number of minimiser buckets; a task holds one
    bucket at a time. By default it grows with the windows counted in a sample, and minimisers with many windows are split.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    others = [F.col(f"`{c}`").alias(f"__keep_{i}") for i, c in enumerate(keep or [])]
    own = [F.col(doc_id).cast("long").alias("doc"), F.hash(F.col(text)).cast("long").alias("key"), F.col(text).cast("string").alias("text")]
    rows = docs.select(*own, *others)
    texts = rows.select("doc", "key", "text").where("doc IS NOT NULL AND length(text) > 0")
    counted, hot, splits = layout(texts, window, minimiser, 8 * parts)
    packed = texts.mapInArrow(A.released(_ship(window, minimiser, buckets or counted, hot, splits)), "bucket long, packed binary")
    spans = packed.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(A.released(_judge(window)), "doc long, key long, start long, end long")
    spans = spans.groupBy("doc", "key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = rows.join(spans, ["doc", "key"], "left").select("doc", *(c for c in rows.columns if c.startswith("__keep_")), "text", "spans")
    kinds = [*joined.schema.fields[:-2], T.StructField("kept_text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]
    cut = joined.mapInArrow(A.released(_cut(as_is)), T.StructType(kinds))
    return cut.select(F.col("doc").alias(doc_id), *(F.col(f"__keep_{i}").alias(c) for i, c in enumerate(keep or [])), "kept_text", "n_words", "n_removed")
