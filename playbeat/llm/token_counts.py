"""Token counts of a unigram tokenizer without making the tokens.

An Aho-Corasick automaton over the vocabulary enumerates all pieces that end at each character; dynamic programming
carries the best score and how many pieces reach it. Ties go as in the tokenizers: of equal scores the piece that
starts first, so the longest, wins. A character that is no piece costs the least score less ten and counts its bytes
where the model falls back to bytes. Scores add in double precision. Texts are cut where no piece can cross; each
part is looked up among those met lately, and the different ones of a slice of texts that are new are worked side by side:
automaton and programme take the same character of all parts at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbeat.llm import arrays as A
from playbeat.llm.pieces import SPACE, Memory, Pieces, Table

#: Characters of a part that is not cut further.
LONG = 64
#: What an unknown character costs beyond the least score.
PENALTY = 10.0


class Automaton:
    """Aho-Corasick automaton that steps through many texts at once; states are numbers, 0 is the root.

    `matched` is the longest piece at the end of what a state has read, as a state of its own, `shorter` the next one that
    ends there, 0 if there is none; `piece` and `size` belong to such states.
    """

    def __init__(self, pieces: list[str]):
        goes, piece, size = [{}], [-1], [0]
        for i, s in enumerate(pieces):
            node = 0
            for c in s:
                if c not in goes[node]:
                    goes[node][c] = len(goes)
                    goes.append({})
                    piece.append(-1)
                    size.append(size[node] + 1)
                node = goes[node][c]
            piece[node] = i
        fail, shorter = [0] * len(goes), [0] * len(goes)
        for node in sorted(range(len(goes)), key=size.__getitem__):
            for c, child in goes[node].items():
                at = fail[node]
                while at and c not in goes[at]:
                    at = fail[at]
                fail[child] = at = goes[at].get(c, 0) if node else 0
                shorter[child] = at if piece[at] >= 0 else shorter[at]
        self.fail, self.shorter, self.piece, self.size = (np.array(x, np.int64) for x in (fail, shorter, piece, size))
        self.matched = np.where(self.piece >= 0, np.arange(len(goes)), self.shorter)
        used = sorted({c for s in pieces for c in s})
        #: Number of each character, 0 for those of no piece.
        self.number = np.zeros(0x110000, np.int64)
        self.number[list(map(ord, used))] = np.arange(1, len(used) + 1)
        self.width = len(used) + 1
        self.first = np.zeros(self.width, np.int64)
        for c, child in goes[0].items():
            self.first[self.number[ord(c)]] = child
        edges = np.array([(n * self.width + self.number[ord(c)], child) for n, g in enumerate(goes) if n for c, child in g.items()], np.int64).reshape(-1, 2)
        self.edges = Table(edges[:, 0], edges[:, 1], -1)

    def step(self, state: np.ndarray, character: np.ndarray) -> np.ndarray:
        """States after one more character each, given by its number."""
        out = self.first[character]
        left = np.flatnonzero(state)
        at, read = state[left], character[left]
        while len(left):
            next_ = self.edges.get(at * self.width + read)
            out[left[next_ >= 0]] = next_[next_ >= 0]
            at = self.fail[at]
            on = (next_ < 0) & (at > 0)
            left, at, read = left[on], at[on], read[on]
        return out


class Viterbi:
    def __init__(self, model: bytes):
        self.pieces = p = Pieces(model)
        names = list(p.score)
        self.found = Automaton(names)
        self.scores = np.array([*p.score.values(), 0.0], np.float64)[self.found.piece]
        self.unknown = min(p.score.values()) - PENALTY
        self.apart = p.byte_fallback and SPACE in p.score
        self.known = Memory(self._packed, 1 << 18)
        self.single = np.zeros(0x110000, bool)
        self.single[[ord(s) for s in names if len(s) == 1]] = True

    def _packed(self, units: list[str]) -> list[bytes]:
        raw = np.stack(self.best_all(units), axis=1).astype(np.float64).tobytes()
        return [raw[i : i + 16] for i in range(0, len(raw), 16)]

    def best_all(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Score and number of pieces of the best path through each stretch of normalised text."""
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        # of these, entry `begin` + k of a part stands for the place behind its k-th character
        begin = np.cumsum(sizes + 1) - sizes - 1
        best, count, odd = (np.zeros(len(codes) + len(units), kind) for kind in (np.float64, np.int64, bool))
        by_size = np.argsort(-sizes, kind="stable")
        longer = np.searchsorted(-sizes[by_size], -np.arange(1, int(sizes.max(initial=0)) + 1), "right")
        first, own = begin[by_size], (begin - np.arange(len(units)))[by_size]
        found, state = self.found, np.zeros(len(units), np.int64)
        for k, n in enumerate(longer.tolist(), 1):
            here, code = first[:n] + k, codes[own[:n] + k - 1]
            state = found.step(state[:n], found.number[code])
            top, steps = np.full(n, -np.inf), np.zeros(n, np.int64)
            at = found.matched[state]
            live = np.flatnonzero(at)
            at = at[live]
            while len(live):  # the longest piece first, which of equals stays
                start = here[live] - found.size[at]
                value = best[start] + self.scores[at]
                better = value > top[live]
                take = live[better]
                top[take], steps[take] = value[better], count[start[better]] + 1
                at = found.shorter[at]
                live, at = live[at > 0], at[at > 0]
            best[here], count[here] = top, steps
            lone = np.flatnonzero(~self.single[code])
            if len(lone):
                cost = best[here[lone] - 1] + self.unknown
                lone, cost = lone[cost > top[lone]], cost[cost > top[lone]]
                at, code = here[lone], code[lone]
                bytes_ = 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)
                count[at] = count[at - 1] + (bytes_ if self.pieces.byte_fallback else ~odd[at - 1])
                best[at], odd[at] = cost, True
        return best[begin + sizes], count[begin + sizes]

    def total_all(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Score and number of pieces of whole texts."""
        p = self.pieces
        if self.apart:
            units, first = p.units(texts, LONG)
        else:
            units, first = [p.form(t)[0] for t in texts], np.arange(len(texts) + 1)
        scores, counts = np.frombuffer(b"".join(self.known.all(units)), np.float64).reshape(-1, 2).T
        text = np.repeat(np.arange(len(texts)), np.diff(first))
        counts = np.bincount(text, weights=counts, minlength=len(texts)).round().astype(np.int64)
        return np.bincount(text, weights=scores, minlength=len(texts)), counts

    def total(self, text: bytes) -> tuple[float, int]:
        scores, counts = self.total_all([text])
        return float(scores[0]), int(counts[0])


_MODELS: dict[int, Viterbi] = {}


def token_counts(docs: DataFrame, model: bytes, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: (doc_id, n_tokens, score).

    n_tokens counts the pieces of the best path without begin or end tokens, score is the path's. Null and empty texts
    have no tokens and score 0. Ids may be null or repeat, as rows are independent. Other columns are ignored. `model`
    is the content of a model file, whose pieces and scores are the unigram vocabulary.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(model)
        if key not in _MODELS:
            _MODELS.clear()
            _MODELS[key] = Viterbi(model)
        own = _MODELS[key]
        for batch in batches:
            buf, offsets = A.text_buffer(batch.column(1))
            for lo, hi in A.slices(offsets):
                raw, at = buf[offsets[lo] : offsets[hi]].tobytes(), (offsets[lo : hi + 1] - offsets[lo]).tolist()
                scores, counts = own.total_all([raw[s:e] for s, e in zip(at[:-1], at[1:])])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(counts), pa.array(scores)], names=["id", "n", "s"])

    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    from pyspark.sql import types as T

    schema = T.StructType([rows.schema["id"], T.StructField("n", T.LongType()), T.StructField("s", T.DoubleType())])
    return rows.mapInArrow(A.released(run), schema).select(F.col("id").alias(doc_id), F.col("n").alias("n_tokens"), F.col("s").alias("score"))
