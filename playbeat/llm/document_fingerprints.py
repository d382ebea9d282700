"""SimHash fingerprints of documents, and the search for all fingerprints within a Hamming radius.

Every occurrence of a term, here two neighbouring words, votes with its letters as weight on each bit of the
fingerprint, up or down as its hash says. The search keeps one table per block of bits, keyed by that block: two
fingerprints within the radius agree on at least one block, so the tables together find all of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbeat.llm import arrays as A

BITS = 128
#: Letters that a word weighs at most.
HEAVY = 15
BLOCK = 1 << 15


def simhash(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Fingerprints of texts, BITS/8 bytes each: words are split at ASCII white space, a text of one word is one term."""
    starts, ends, texts = A.word_bounds(buf, offsets)
    hashes = A.word_hashes(buf, starts, ends)
    weights = np.minimum(ends - starts, HEAVY).astype(np.uint8)
    sizes = np.diff(texts)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    pair = owner[:-1] == owner[1:]
    keep = np.append(pair, False) | (sizes[owner] == 1)
    terms = np.where(np.append(pair, False), A.mix(hashes + np.uint64(3) * np.append(hashes[1:], np.uint64(0))), hashes)[keep]
    weights = (weights + np.where(np.append(pair, False), np.append(weights[1:], 0), 0)).astype(np.uint8)[keep]
    owner = owner[keep]
    votes, total = np.zeros((len(sizes), BITS), np.int64), np.bincount(owner, weights, len(sizes)).astype(np.int64)
    for lo in range(0, len(terms), BLOCK):
        some, own = terms[lo : lo + BLOCK], owner[lo : lo + BLOCK]
        words = np.column_stack([A.mix(some ^ np.uint64((i + 1) * 0x2545F4914F6CDD1D & (1 << 64) - 1)) for i in range(BITS // 64)])
        bits = np.unpackbits(words.view(np.uint8), axis=1)
        bits *= weights[lo : lo + BLOCK, None]
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        votes[own[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    return np.packbits(2 * votes > total[:, None], axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated cosine of the weighted terms from the angle that the differing bits show, 0 to 1."""
    differing = np.bitwise_count(a ^ b).sum(1)
    return np.where(differing == 0, 1.0, np.maximum(0.0, np.cos(np.pi * differing / BITS)))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64)


def prints(texts: list[bytes]) -> np.ndarray:
    buf, offsets = joined(texts)
    parts = [simhash(buf[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]) for lo, hi in A.slices(offsets)]
    return np.concatenate(parts) if parts else np.zeros((0, BITS // 8), np.uint8)


def fingerprint_texts(docs: DataFrame, *, text: str = "text", to: str = "fingerprint") -> DataFrame:
    """All columns of every row and the hex fingerprint of its text; null and empty texts have fingerprint zero."""
    names = [c for c in docs.columns if c != to]
    where = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = A.text_buffer(batch.column(where).cast(pa.string()))
            for lo, hi in A.slices(offsets):
                found = simhash(buf[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns, pa.array([f.tobytes().hex() for f in found])], names=[*names, to])

    from pyspark.sql import types as T

    return docs.select(*(F.col(f"`{c}`") for c in names)).mapInArrow(run, T.StructType([*(docs.schema[c] for c in names), T.StructField(to, T.StringType())]))


def _place(cuts: np.ndarray, first: int, buckets: int):
    """Rows to the bucket of their id; the first row of a bucket also goes ahead of time to the end of the one before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order = batch.column(0).to_numpy()
            own = np.searchsorted(cuts, order, "right")
            opens = np.flatnonzero((order == first) | np.isin(order, cuts))
            before = np.where(order[opens] == first, buckets - 1, own[opens] - 1)
            for rows, bucket, ahead in ((None, own, False), (opens, before, True)):
                part = batch if rows is None else batch.take(pa.array(rows))
                if part.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int64)), pa.array(np.full(part.num_rows, ahead)), *part.columns], names=["bucket", "ahead", "order", "text"])

    return run


def _beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (bucket, ahead, order, text) to the comparison of every row that is not ahead with the row after it."""
    held: tuple | None = None  # bucket, order, text and fingerprint of a row that waits for the next

    def compared(order: list, texts: list[bytes], found: np.ndarray) -> pa.RecordBatch:
        edited, sizes = [], []
        for own, after in zip(texts[:-1], texts[1:]):
            t, nxt = own.decode(errors="replace"), after.decode(errors="replace")
            k = len(t) // 4
            edited.append((t[: len(t) - k] + nxt[:k]).encode())
            sizes.append(len(t))
        changed = prints(edited)
        own, after = found[:-1], found[1:]
        columns = [
            pa.array(order, pa.int64()), pa.array(sizes, pa.int64()), pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()),
            pa.array([f.tobytes().hex() for f in own], pa.string()), pa.array([f.tobytes().hex() for f in changed], pa.string()),
            pa.array(likeness(own, changed)), pa.array(likeness(own, after)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["order", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    done = None  # the bucket whose last row has met its next one
    for batch in batches:
        buf, offsets = A.text_buffer(batch.column(3))
        for lo, hi in A.slices(offsets, 1 << 20):
            raw, at = buf[offsets[lo] : offsets[hi]].tobytes(), (offsets[lo : hi + 1] - offsets[lo]).tolist()
            texts = [raw[s:e] for s, e in zip(at[:-1], at[1:])]
            bucket, ahead = batch.column(0).slice(lo, hi - lo).to_numpy(), batch.column(1).slice(lo, hi - lo).to_numpy(zero_copy_only=False)
            order, found = batch.column(2).slice(lo, hi - lo).to_pylist(), prints(texts)
            starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])).tolist()
            for s, e in zip(starts, [*starts[1:], len(texts)]):
                if bucket[s] == done:
                    continue
                own = int((~ahead[s:e]).sum())  # rows of the bucket itself stand first
                last = min(s + own + 1, e)
                seq, ids, marks = texts[s:last], order[s:last], found[s:last]
                if held is not None and held[0] == bucket[s]:
                    seq, ids, marks = [held[2], *seq], [held[1], *ids], np.concatenate([held[3], marks])
                held = None
                if len(seq) > 1:
                    yield compared(ids[:-1], seq, marks)
                if last > s + own:
                    done = bucket[s]
                else:
                    held = (bucket[s], ids[-1], seq[-1], marks[-1:])


def fingerprints_with_next(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text has the last quarter of the code points replaced by the first as many (or all) of the next document
    in ascending id; after the last comes the first. Likeness is between the row's fingerprint and that of the edited
    text and of the next document, 1 for equal ones. Null texts count as empty and have fingerprint zero. Rows without
    an id come first; rows of one id are in order of their text. A table of one row is its own next. Other columns are
    ignored. One shuffle by ranges of ids; the first row of a range also goes to the range before.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = -(1 << 63)
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(least)).alias("order"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    shares = [i / parts for i in range(1, parts)] or [0.5]
    first, cuts = rows.agg(F.min("order"), F.percentile_approx("order", shares, 10 * parts + 1000)).first()
    if first is None:
        cuts, first = [], least
    cuts = np.unique(np.array([c for c in cuts if c > first], np.int64))
    buckets = len(cuts) + 1
    placed = rows.mapInArrow(_place(cuts, first, buckets), "bucket long, ahead boolean, order long, text string")
    placed = placed.repartitionById(buckets, F.col("bucket").cast("int")) if hasattr(placed, "repartitionById") else placed.repartition(buckets, "bucket")
    placed = placed.sortWithinPartitions("bucket", "ahead", "order", "text")
    found = placed.mapInArrow(_beside, "order long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return found.select(F.when(F.col("order") != least, F.col("order")).alias(doc_id), *(c for c in found.columns if c != "order"))


def near_fingerprints(queries: DataFrame, rows: DataFrame, radius: int = 3, *, fingerprint: str = "fingerprint") -> DataFrame:
    """(fingerprint, n_near) of every distinct fingerprint in `queries`: how many of `rows` lie within the radius, itself included.

    Fingerprints are hex strings of one length; nulls are left out. Equal ones are one entry with a count, and each of the
    radius + 1 tables joins on its block of bits. A pair that shares several blocks counts in the first of them only.
    """
    digits = BITS // 4
    blocks = radius + 1
    edges = [round(i * digits / blocks) for i in range(blocks + 1)]

    def entries(df: DataFrame, count: list) -> DataFrame:
        some = df.where(F.col(fingerprint).isNotNull()).groupBy(F.col(fingerprint).alias("fp")).agg(F.count("*").alias("n"))
        keys = F.array(*(F.struct(F.lit(i).alias("block"), F.substring("fp", edges[i] + 1, edges[i + 1] - edges[i]).alias("key")) for i in range(blocks)))
        return some.select("fp", *count, F.inline(keys))

    left, right = entries(queries, []), entries(rows, ["n"]).withColumnRenamed("fp", "other")
    halves = [F.bit_count(F.conv(F.substring("fp", i + 1, 15), 16, 10).cast("long").bitwiseXOR(F.conv(F.substring("other", i + 1, 15), 16, 10).cast("long"))) for i in range(0, digits, 15)]
    apart = sum(halves[1:], halves[0])
    first = F.lit(False)
    for i in reversed(range(blocks)):
        same = F.substring("fp", edges[i] + 1, edges[i + 1] - edges[i]) == F.substring("other", edges[i] + 1, edges[i + 1] - edges[i])
        first = F.when(same, F.col("block") == i).otherwise(first)
    met = left.join(right, ["block", "key"]).where((apart <= radius) & first)
    return met.groupBy(F.col("fp").alias(fingerprint)).agg(F.sum("n").alias("n_near"))
