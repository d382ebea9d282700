"""Language identification with bit-sliced Bloom filters of n-grams, one bit of every slot per language.

All languages' filters have the same size and hashes, so they lie side by side: a slot holds a mask of the languages
whose filter has that bit set, and the bitwise AND of an n-gram's slots is the mask of all languages that contain it.
The votes of a text are popcounts of these masks by language, less what false positives add, and the most votes decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playbeat.llm import arrays as A

#: An n-gram is this many bytes of the folded text, hashed to GRAM_BITS bits.
GRAM, GRAM_BITS = 4, 20
FOLD = np.full(256, 32, np.uint8)
FOLD[128:] = np.arange(128, 256)
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)


def grams(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of each text and their offsets: letters in lower case, all else in ASCII is space, and spaces alone are left out.

    A text counts as standing between spaces.
    """
    texts = len(offsets) - 1
    sizes = np.diff(offsets) + 2
    at = np.append(0, np.cumsum(sizes))
    folded = np.full(at[-1], 32, np.uint8)
    inside = np.ones(at[-1], bool)
    inside[at[:-1]] = inside[at[1:] - 1] = False
    folded[inside] = FOLD[buf]
    code = np.zeros(max(len(folded) - GRAM + 1, 0), np.uint32)
    letters = np.zeros(len(code), np.uint8)
    for i in range(GRAM):
        part = folded[i : len(code) + i]
        code = code << np.uint32(8) | part
        letters += part != 32
    owner = np.repeat(np.arange(texts), sizes)
    good = (letters >= 2) & (owner[: len(code)] == owner[GRAM - 1 :]) if len(code) else np.zeros(0, bool)
    marks = (code[good] * np.uint32(2654435769)) >> np.uint32(32 - GRAM_BITS)
    return marks, np.append(0, np.cumsum(np.bincount(owner[: len(code)][good], minlength=texts)))


def has_letter(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a letter, of any script."""
    lower = buf | 32
    ascii_letter = np.append(0, np.cumsum((lower >= 97) & (lower <= 122)))
    out = ascii_letter[offsets[1:]] > ascii_letter[offsets[:-1]]
    high = np.append(0, np.cumsum(buf >= 128))
    for i in np.flatnonzero(~out & (high[offsets[1:]] > high[offsets[:-1]])):
        out[i] = any(c.isalpha() for c in buf[offsets[i] : offsets[i + 1]].tobytes().decode(errors="replace"))
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to n-gram counts of the task, at most one row per language and n-gram for each 16 languages seen."""
    counts: dict[str, np.ndarray] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, n in counts.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(n[some])], names=["lang", "gram", "n"])
        counts.clear()

    for batch in batches:
        for lang in batch.column(0).unique().to_pylist():
            part = batch.filter(pa.compute.equal(batch.column(0), lang))
            if lang not in counts:
                if len(counts) >= 16:
                    yield from flush()
                counts[lang] = np.zeros(1 << GRAM_BITS, np.int64)
            buf, offsets = A.text_buffer(part.column(1))
            for lo, hi in A.slices(offsets):
                marks, _ = grams(buf[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                counts[lang] += np.bincount(marks, minlength=1 << GRAM_BITS)
    yield from flush()


class Filters:
    """The slots, the languages by bit, and each language's share of false positives."""

    def __init__(self, slots: np.ndarray, langs: list[str], hashes: int):
        self.slots, self.langs, self.hashes = slots, langs, hashes
        bits = [(slots[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).mean() for i in range(len(langs))]
        self.false = np.array(bits) ** hashes

    def masks(self, marks: np.ndarray) -> np.ndarray:
        """Languages that contain each n-gram, as bits of one or more words."""
        out = None
        for place in places(marks.astype(np.uint64), len(self.slots), self.hashes):
            found = self.slots[place]
            out = found if out is None else out & found
        return out

    def votes(self, marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Corrected share of each text's n-grams that each language contains."""
        masks, n = self.masks(marks), np.diff(offsets)
        some = n > 0
        out = np.zeros((len(n), len(self.langs)))
        for i in range(len(self.langs)):
            hit = (masks[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).astype(np.int64)
            out[some, i] = np.add.reduceat(hit, offsets[:-1][some]) if some.any() else 0
        share = out / np.maximum(n, 1)[:, None]
        return np.clip((share - self.false) / np.maximum(1 - self.false, 1e-9), 0, 1) * some[:, None]


def places(marks: np.ndarray, slots: int, hashes: int) -> list[np.ndarray]:
    """Slots of each n-gram."""
    one = A.mix(marks + np.uint64(1))
    step = (one >> np.uint64(32)) | np.uint64(1)
    return [((one + np.uint64(i) * step) % np.uint64(slots)).astype(np.int64) for i in range(hashes)]


def learn_languages(docs: DataFrame, *, slots: int = 1 << 18, hashes: int = 3, ratio: float = 0.5, text: str = "text", lang: str = "lang") -> Filters:
    """Filters from labelled texts; rows with a null label or text are left out.

    A language contains an n-gram if its share of the language's n-grams is at least `ratio` of its largest share in any
    language, and above one in ten million. The counts come from all rows. What reaches the driver are the labels and
    the slots, whose number is a parameter.
    """
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    counts = rows.mapInArrow(_count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    share = counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("lang")))
    share = share.withColumn("most", F.max("share").over(Window.partitionBy("gram")))
    held = share.where((F.col("share") >= ratio * F.col("most")) & (F.col("share") > 1e-7)).select("lang", "gram")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in places(batch.column(1).to_numpy().astype(np.uint64), slots, hashes):
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(place)], names=["lang", "slot"])

    packed = held.mapInArrow(mark, "lang string, slot long").distinct().groupBy("lang").agg(F.array_sort(F.collect_list(F.col("slot").cast("int"))).alias("slots"))
    sets = sorted((r.lang, r.slots) for r in packed.collect())
    table = np.zeros((slots, max(1, -(-len(sets) // 64))), np.uint64)
    for i, (_, own) in enumerate(sets):
        table[np.array(own, np.int64), i // 64] |= np.uint64(1) << np.uint64(i % 64)
    return Filters(table, [name for name, _ in sets], hashes)


def predict_language(docs: DataFrame, filters: Filters, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: (doc_id, lang_pred, score).

    A null text, or one without a letter, is `und` with score 0; so is every text where nothing was learned. score is
    the winning language's part of all corrected votes; of equal votes the first language in order wins, also where no
    language has any. Ids may be null or repeat. Other columns are ignored.
    """
    names = np.array([*filters.langs, "und"], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = A.text_buffer(batch.column(1))
            for lo, hi in A.slices(offsets):
                part, at = buf[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                if filters.langs:
                    votes = filters.votes(*grams(part, at))
                    best, total = votes.argmax(1), votes.sum(1)
                    score = votes.max(1) / np.where(total > 0, total, 1)
                    none = ~has_letter(part, at)
                    best[none], score[none] = len(filters.langs), 0.0
                else:
                    best, score = np.full(hi - lo, 0), np.zeros(hi - lo)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(names[best], pa.string()), pa.array(score)], names=["id", "lang", "score"])

    from pyspark.sql import types as T

    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, schema).select(F.col("id").alias(doc_id), F.col("lang").alias("lang_pred"), "score")
