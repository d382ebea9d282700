"""Quality grades by ordinal cumulative-link regression on hashed text features.

One weight vector serves all grades; ordered thresholds cut its score: P(grade > k) = logistic(score - threshold k).
The features are which hashed words occur, and how often hashed shapes and repeats of words occur, relative to the
length. The fit reads a bounded sample of rated rows; everything else runs over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playbeat.llm import arrays as A

BITS = 18
#: Kinds of bytes in a word's shape: lower, upper, digit, each other ASCII byte by itself, beyond ASCII.
SHAPE = np.arange(256).astype(np.uint8)
SHAPE[97:123], SHAPE[65:91], SHAPE[48:58], SHAPE[128:] = 97, 65, 48, 97
FOLD = np.arange(256).astype(np.uint8)
FOLD[65:91] = np.arange(97, 123)


def features(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, feature and value of every feature of the texts, each feature once per text, in order."""
    starts, ends, texts = A.word_bounds(buf, offsets)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(texts))
    folded = FOLD[buf]
    letter = (folded >= 97) & (folded <= 122) | (folded >= 128)
    # words without the marks around them
    words = A.Rolling(np.where(letter, folded, 0)[letter]) if letter.any() else A.Rolling(np.zeros(0, np.uint8))
    place = np.append(0, np.cumsum(letter))
    plain = words.hashes(place[starts], place[ends])
    # shapes with runs of one kind taken together
    kind = SHAPE[buf]
    first = np.ones(len(buf), bool)
    first[1:] = kind[1:] != kind[:-1]
    first[starts] = True
    shape_place = np.append(0, np.cumsum(first))
    shapes = A.Rolling(kind[first]).hashes(shape_place[starts], shape_place[ends]) ^ np.uint64(0x5BD1E995)
    again = np.zeros(len(starts), bool)
    again[1:] = (plain[1:] == plain[:-1]) & (owner[1:] == owner[:-1])
    size = np.uint64(1 << BITS)
    half = np.uint64(1 << (BITS - 1))
    kinds = np.concatenate([plain % half, half + shapes % (half - np.uint64(1)), np.full(again.sum(), size - np.uint64(1))])
    text = np.concatenate([owner, owner, owner[again]]).astype(np.uint64)
    pairs, counts = np.unique((text << np.uint64(BITS)) | kinds, return_counts=True)
    text, feature = (pairs >> np.uint64(BITS)).astype(np.int64), (pairs & (size - np.uint64(1))).astype(np.int64)
    share = counts / np.maximum(np.diff(texts), 1)[text]
    return text, feature, np.where(feature < int(half), 1.0, share)


class Ordinal:
    """Weights by feature and the ordered thresholds between grades."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def tails(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """P(grade > k) of every text, for each threshold k."""
        text, feature, value = features(buf, offsets)
        score = np.bincount(text, self.weights[feature] * value, minlength=len(offsets) - 1)
        return logistic(score[:, None] - self.thresholds[None, :])


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(text: np.ndarray, feature: np.ndarray, value: np.ndarray, grade: np.ndarray, least: int, rounds: int = 300, rate: float = 0.1, decay: float = 1e-4, apart: float = 4.5) -> Ordinal:
    """Maximum likelihood by full-batch Adam.

    A feature gets a weight if at least `least` texts have it and, at some threshold, texts above and below differ in
    having it by `apart` standard errors, so that words of no account do not learn the sample by heart.
    """
    n, top = len(grade), int(grade.max()) if len(grade) else 0
    weights = np.zeros(1 << BITS)
    if not n or top < 1 or (grade == grade[0]).all():
        return Ordinal(weights, np.full(max(top, 1), -40.0))
    seen = np.bincount(feature, minlength=1 << BITS)
    odds = np.zeros(1 << BITS)
    for k in range(top):
        high = grade > k
        up, down = max(high.sum(), 1), max((~high).sum(), 1)
        a = np.bincount(feature, high[text], minlength=1 << BITS)
        spread = np.sqrt(np.maximum(seen / n * (1 - seen / n), 1 / n) * (1 / up + 1 / down))
        odds = np.maximum(odds, np.abs(a / up - (seen - a) / down) / spread)
    used = np.flatnonzero((seen >= least) & (odds >= apart))
    slot = np.full(1 << BITS, -1)
    slot[used] = np.arange(len(used))
    some = slot[feature] >= 0
    text, own, value = text[some], slot[feature[some]], value[some]
    above = np.array([(grade > k).mean() for k in range(top)])
    start = np.minimum.accumulate(np.clip(above, 1e-3, 1 - 1e-3))
    cuts = np.log((1 - start) / start)
    state = np.concatenate([np.zeros(len(used)), cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-2))])
    moment, scale = np.zeros_like(state), np.zeros_like(state)
    for step in range(1, rounds + 1):
        w, gaps = state[: len(used)], np.exp(state[len(used) + 1 :])
        cuts = state[len(used)] + np.append(0, np.cumsum(gaps))
        score = np.bincount(text, w[own] * value, minlength=n)
        tail = np.column_stack([np.ones(n), logistic(score[:, None] - cuts), np.zeros(n)])
        slope = tail * (1 - tail)
        rows = np.arange(n)
        chance = np.maximum(tail[rows, grade] - tail[rows, grade + 1], 1e-9)
        lift = (slope[rows, grade] - slope[rows, grade + 1]) / chance / n
        at_cut = np.zeros((n, top + 2))
        at_cut[rows, grade] -= slope[rows, grade] / chance / n
        at_cut[rows, grade + 1] += slope[rows, grade + 1] / chance / n
        by_cut = at_cut[:, 1 : top + 1].sum(0)
        later = np.cumsum(by_cut[::-1])[::-1]
        gradient = np.concatenate([np.bincount(own, lift[text] * value, minlength=len(used)) - decay * w, later[:1], later[1:] * gaps])
        moment = 0.9 * moment + 0.1 * gradient
        scale = 0.999 * scale + 0.001 * gradient**2
        state = state + rate * (moment / (1 - 0.9**step)) / (np.sqrt(scale / (1 - 0.999**step)) + 1e-8)
    weights[used] = state[: len(used)]
    return Ordinal(weights, state[len(used)] + np.append(0, np.cumsum(np.exp(state[len(used) + 1 :]))))


def fit_quality(docs: DataFrame, ratings: DataFrame, *, sample: int = 8192, seed: int = 11, doc_id: str = "doc_id", text: str = "text", grade: str = "grade") -> Ordinal:
    """A model from rated documents: `ratings` has doc_id and an integer grade from 0 up, higher for better.

    At most `sample` different pairs of id and grade are used, chosen by a seeded hash of their ids, so the choice does
    not depend on order or partitions; the features of one text for each go to the driver. Of the texts that repeat an id
    the one with the least hash counts. Null ids, grades and texts are left out. With fewer than two grades the model
    accepts everything.
    """
    rated = ratings.select(F.col(doc_id).cast("long").alias("id"), F.col(grade).cast("int").alias("grade")).where("id IS NOT NULL AND grade >= 0").distinct()
    chosen = rated.orderBy(F.xxhash64("id", F.lit(seed)), "id", "grade").limit(sample)
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    # the broadcast side has `sample` rows at most, and so has the result, as texts of an id are cut to one, first per task
    own = texts.join(F.broadcast(chosen.select("id")), "id", "left_semi").groupBy("id").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))
    rows = own.join(F.broadcast(chosen), "id").select("grade", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = A.text_buffer(batch.column(1))
            for lo, hi in A.slices(offsets):
                own, feature, value = features(buf[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                at = np.searchsorted(own, np.arange(hi - lo + 1)).tolist()
                pairs = [(feature[s:e].astype(np.int32).tobytes(), value[s:e].astype(np.float32).tobytes()) for s, e in zip(at[:-1], at[1:])]
                columns = [batch.column(0).slice(lo, hi - lo), pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["grade", "features", "values"])

    # equal texts of one grade count once, so that a group of copies does not look like evidence
    found = sorted({(bytes(r[1]), bytes(r[2]), r[0]) for r in rows.mapInArrow(run, "grade int, features binary, values binary").toLocalIterator()})
    kinds = [np.frombuffer(f, np.int32).astype(np.int64) for f, _, _ in found]
    values = [np.frombuffer(v, np.float32).astype(np.float64) for _, v, _ in found]
    grades = np.array([g for _, _, g in found], np.int64)
    owner = np.repeat(np.arange(len(found)), [len(k) for k in kinds]) if found else np.zeros(0, np.int64)
    empty = [np.zeros(0, np.int64)]
    return fit(owner, np.concatenate(kinds or empty), np.concatenate(values or empty), grades, least=3)


def predict_quality(docs: DataFrame, model: Ordinal, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The `keep` columns (all by default) of every row, `expected_grade` and `tails`, P(grade > k) for k = 0, 1, ...

    Null and empty texts have no features and get what the thresholds alone give. Rows are independent, so repeated rows
    repeat. An output column that the table already has is replaced.
    """
    made = ["expected_grade", "tails"]
    names = [c for c in (keep or docs.columns) if c not in made]
    # a text that is kept goes to the workers once
    shared = text in names and docs.schema[text].dataType == T.StringType()
    n, where = len(names), names.index(text) if shared else len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = A.text_buffer(batch.column(where))
            for lo, hi in A.slices(offsets, 1 << 20):
                tails = model.tails(buf[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                at = pa.array(np.arange(0, tails.size + 1, tails.shape[1], dtype=np.int32))
                columns = [pa.array(tails.sum(1)), pa.ListArray.from_arrays(at, pa.array(tails.ravel()))]
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns[:n], *columns], names=[*names, *made])

    kinds = [T.StructField("expected_grade", T.DoubleType()), T.StructField("tails", T.ArrayType(T.DoubleType()))]
    schema = T.StructType([*(docs.schema[c] for c in names), *kinds])
    more = [] if shared else [F.col(text).cast("string").alias("__text")]
    return docs.select(*(F.col(f"`{c}`") for c in names), *more).mapInArrow(A.released(run), schema)
