"""SentencePiece BPE encoding with offsets into the source, and decoding.

Normalisation takes the longest prefix the model's compiled character map knows, keeps where each byte came from, and
projects every piece to its original byte span. Merges never cross a place that no piece spans, so texts are cut there;
each part is looked up among those met lately, and the different ones of a slice of texts that are new are merged side by
side, one merge of every part at a time.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbeat.llm import arrays as A
from playbeat.llm.pieces import BYTE, CONTROL, SPACE, UNKNOWN, Memory, Pieces, Table

#: Symbols from which a heap finds the next merge.
LONG = 64
#: Rank of a pair that is no piece.
NONE = 1 << 40


class Codec:
    def __init__(self, model: bytes):
        self.pieces = p = Pieces(model)
        self.known = Memory(self._parts, 1 << 18)
        self._symbols()
        forms = [b"" if k == CONTROL else p.unknown_surface.encode() if k == UNKNOWN else bytes([int(n[1:-1], 16)]) if k == BYTE else n.replace(SPACE, " ").encode() for n, k in zip(p.names, p.kinds)]
        self.form = np.frombuffer(b"".join(forms), np.uint8)
        self.form_at = np.append(0, np.cumsum([len(f) for f in forms]))
        self.is_byte = np.array([k == BYTE for k in p.kinds])
        self.follows = np.array([k == BYTE and 0x80 <= int(n[1:-1], 16) < 0xC0 for n, k in zip(p.names, p.kinds)])
        self.spaced = np.array([n.startswith(SPACE) and k not in (CONTROL, UNKNOWN, BYTE) for n, k in zip(p.names, p.kinds)])

    def _symbols(self) -> None:
        """Numbers for pieces and their characters, and the table of pairs of symbols that make a piece."""
        p = self.pieces
        names = sorted({*p.score, *(c for s in p.score for c in s)})
        number = {s: i for i, s in enumerate(names)}
        self.piece_of = np.array([p.id.get(s, -1) for s in names], np.int32)
        self.symbol_of = np.full(0x110000, -1, np.int32)
        for s, i in number.items():
            if len(s) == 1:
                self.symbol_of[ord(s)] = i
        pairs = [(number[s[:i]], number[s[i:]], p.rank[s], number[s]) for s in p.score for i in range(1, len(s)) if s[:i] in number and s[i:] in number]
        table = np.array(pairs, np.int64).reshape(-1, 4)
        # a pair's place in the list; the last entry is for pairs that are no piece, symbols below 0 make none
        self.size, self.pair = len(names) + 1, Table((table[:, 0] + 1) * (len(names) + 1) + table[:, 1] + 1, np.arange(len(table)), len(table))
        self.pair_rank, self.pair_symbol = np.append(table[:, 2], NONE), np.append(table[:, 3], -1)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair of symbols, NONE if it is no piece, and the symbol it makes."""
        at = self.pair.get((left.astype(np.int64) + 1) * self.size + right + 1)
        return self.pair_rank[at], self.pair_symbol[at]

    def merge_all(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many stretches of normalised text, and where those of each begin (one more than units).

        In each stretch always the best-scored neighbours, the leftmost of equals, are joined.
        """
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        symbol, place, unit = self.symbol_of[codes], np.arange(len(codes)), np.repeat(np.arange(len(units)), sizes)
        rank, makes = np.full(len(codes), NONE), np.full(len(codes), -1)
        if len(codes) > 1:
            rank[:-1], makes[:-1] = self._ranks(symbol[:-1], symbol[1:])
            rank[:-1][unit[1:] != unit[:-1]] = NONE
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(symbol):
            first = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
            best = np.minimum.reduceat(rank, first)
            counts = np.diff(np.append(first, len(unit)))
            best = np.repeat(best, counts)
            open_ = best < NONE
            if not open_.all():
                done.append((unit[~open_], place[~open_], symbol[~open_]))
                symbol, place, unit, rank, makes, best = (x[open_] for x in (symbol, place, unit, rank, makes, best))
                if not len(symbol):
                    break
            at = np.flatnonzero(rank == best)
            at = at[np.append(True, unit[at[1:]] != unit[at[:-1]])]  # one of each unit
            symbol[at] = makes[at]
            stay = np.ones(len(symbol), bool)
            stay[at + 1] = False
            at = at - np.arange(len(at))  # one symbol went for each merge before
            symbol, place, unit, rank, makes = (x[stay] for x in (symbol, place, unit, rank, makes))
            at = np.concatenate([at, at[at > 0] - 1])
            right = np.minimum(at + 1, len(symbol) - 1)
            pair = (unit[at] == unit[right]) & (at != right)
            found, made = self._ranks(symbol[at], symbol[right])
            rank[at], makes[at] = np.where(pair, found, NONE), made
        if not done:
            return np.zeros(0, np.int32), np.zeros(len(units) + 1, np.int64)
        unit, place, symbol = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(place, kind="stable")
        unit, place, symbol = unit[order], place[order], symbol[order]
        ids = np.where(symbol >= 0, self.piece_of[symbol], -1)
        odd = np.flatnonzero(ids < 0)
        counts = np.ones(len(ids), np.int64)
        if len(odd):  # a symbol that is no piece is one character
            more = [self._unknown(chr(c)) for c in codes[place[odd]].tolist()]
            counts[odd] = [len(m) for m in more]
            starts = np.cumsum(counts) - counts
            out = np.repeat(ids, counts)
            fill = np.repeat(starts[odd], counts[odd]) + np.concatenate([np.arange(len(m)) for m in more])
            out[fill] = np.concatenate(more)
            ids = out
        per_unit = np.bincount(unit, weights=counts, minlength=len(units)).astype(np.int64)
        return ids.astype(np.int32), np.append(0, np.cumsum(per_unit))

    def _unknown(self, character: str) -> list[int]:
        p = self.pieces
        return [p.bytes[b] for b in character.encode()] if p.byte_fallback else [p.unknown]

    def merge(self, text: str) -> list[int]:
        """Ids of one long stretch."""
        known = self.pieces.id
        return [i for s in self._merge_long(list(text)) for i in ([known[s]] if s in known else self._unknown(s))]

    def _merge_long(self, symbols: list[str]) -> list[str]:
        score, n = self.pieces.score, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(-score[s], i, s) for i in range(n - 1) if (s := symbols[i] + symbols[i + 1]) in score]
        heapq.heapify(heap)
        while heap:
            _, i, joined = heapq.heappop(heap)
            j = after[i]
            if not symbols[i] or j >= n or len(symbols[i]) + len(symbols[j]) != len(joined) or symbols[i] + symbols[j] != joined:
                continue
            symbols[i], symbols[j] = joined, ""
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                if (s := joined + symbols[after[j]]) in score:
                    heapq.heappush(heap, (-score[s], i, s))
            if before[i] >= 0 and (s := symbols[before[i]] + joined) in score:
                heapq.heappush(heap, (-score[s], before[i], s))
        return [s for s in symbols if s]

    def _parts(self, units: list[str]) -> list[bytes]:
        short = [u for u in units if len(u) <= LONG]
        ids, begin = self.merge_all(short)
        raw, at = ids.tobytes(), (4 * begin).tolist()
        own = iter([raw[b:e] for b, e in zip(at[:-1], at[1:])])
        return [next(own) if len(u) <= LONG else np.array(self.merge(u), np.int32).tobytes() for u in units]

    def encode_all(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts, and where those of each begin (one more than texts)."""
        units, first = self.pieces.units(texts, LONG)
        parts = self.known.all(units)
        offsets = np.append(0, np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) // 4))
        return np.frombuffer(b"".join(parts), np.int32), offsets[first]

    def encode(self, text: bytes) -> np.ndarray:
        """Ids of a whole text."""
        return self.encode_all([text])[0]

    def spans_all(self, texts: list[bytes], ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Source byte range of every piece of the texts' encodings; of a character in bytes the last one has it, as in the library."""
        counts = np.diff(offsets)
        grown = np.append(0, np.cumsum(np.diff(self.form_at)[ids]))
        ends = grown[1:] - np.repeat(grown[offsets[:-1]] + (1 if self.pieces.prefix else 0), counts)
        begins = np.maximum(ends - np.diff(grown), 0)
        for text, lo, hi in zip(texts, offsets[:-1].tolist(), offsets[1:].tolist()):
            if not self.pieces.swaps(text):
                begins[lo:hi], ends[lo:hi] = self._aligned(text, ids[lo:hi])
        byte, follows = self.is_byte[ids], self.follows[ids]
        if byte.any():
            starts = np.zeros(len(ids), bool)  # the first piece of a text continues none
            starts[offsets[:-1][counts > 0]] = True
            lead = np.maximum.accumulate(np.where(follows & ~starts, 0, np.arange(len(ids))))
            begins = np.where(byte, begins[lead], begins)
            more = byte & np.append(follows[1:] & ~starts[1:], False)
            ends = np.where(more, begins, ends)
        return begins, ends

    def spans(self, text: bytes, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same of one text."""
        return self.spans_all([text], ids, np.array([0, len(ids)]))

    def _aligned(self, text: bytes, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Source bytes of each piece of one text through the alignment of its normal form."""
        form, source = self.pieces.form(text)
        raw, at, ends = form.encode(), 0, []
        for i in ids.tolist():
            if self.pieces.kinds[i] == UNKNOWN:
                at += len(raw[at:].decode()[0].encode())
            else:
                at += 1 if self.is_byte[i] else len(self.pieces.names[i].encode())
            ends.append(at)
        where, places = np.array(ends, np.int64), np.array(source)
        return (places[np.append(0, where[:-1])] if len(where) else where), places[where]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts of id lists, as bytes with offsets."""
        body, at = A.gather(self.form, self.form_at[ids], self.form_at[ids + 1])
        starts, ends = at[offsets[:-1]], at[offsets[1:]]
        if self.pieces.prefix or self.pieces.squeeze:
            seen = np.append(0, np.cumsum(np.diff(at) > 0))
            first = np.searchsorted(seen, seen[offsets[:-1]], "right") - 1  # the first piece with a form
            some = first < offsets[1:]
            starts = starts + np.where(some, self.spaced[ids[np.where(some, first, 0)]] if len(ids) else False, False)
        body, out = A.gather(body, starts, ends)
        if self.is_byte[ids].any():
            try:
                whole = body.tobytes().decode() is not None and (np.diff(at)[~self.is_byte[ids]] > 0).all()
            except UnicodeDecodeError:
                whole = False
            if not whole:
                return self._repaired(ids, offsets)
        return body, out

    def _repaired(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As decode, with U+FFFD for each byte that forms no character with the byte pieces next to it."""
        texts = []
        for lo, hi in zip(offsets[:-1], offsets[1:]):
            out, run = [], b""
            for i in [*ids[lo:hi].tolist(), -1]:
                if i >= 0 and self.is_byte[i]:
                    run += self.form[self.form_at[i] : self.form_at[i + 1]].tobytes()
                    continue
                if run:
                    out.append(_characters(run))
                    run = b""
                if i >= 0:
                    form = self.form[self.form_at[i] : self.form_at[i + 1]].tobytes()
                    strip = self.spaced[i] and not any(out) and (self.pieces.prefix or self.pieces.squeeze)
                    out.append(form[1:] if strip else form)
            texts.append(b"".join(out))
        return np.frombuffer(b"".join(texts), np.uint8), np.append(0, np.cumsum([len(t) for t in texts]))


def _characters(raw: bytes) -> bytes:
    out = b""
    while raw:
        try:
            raw.decode()
            return out + raw
        except UnicodeDecodeError as error:
            out, raw = out + raw[: error.start] + "�".encode(), raw[error.start + 1 :]
    return out


_CODECS: dict[int, Codec] = {}


def codec(model: bytes) -> Codec:
    """One codec per worker process and model, so that its memory serves all tasks of the worker."""
    key = hash(model)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(model)
    return _CODECS[key]


def _list(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def encode_texts(docs: DataFrame, model: bytes, *, text: str = "text", keep: list[str] | None = None, spans: bool = False) -> DataFrame:
    """The `keep` columns (all but the text by default) of every row, and `ids array<int>`.

    With `spans`, also `begins` and `ends array<int>`: for each id the bytes of the source it stands for. No begin or
    end ids are added. Null and empty texts have no ids. Rows are independent, so repeated rows repeat. `model` is the
    content of a BPE model file; an output column that the table already has is replaced.
    """
    made = ["ids", *(["begins", "ends"] if spans else [])]
    names = [c for c in (keep if keep is not None else docs.columns) if c not in made and (keep is not None or c != text)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            n = batch.num_columns - 1
            buf, offsets = A.text_buffer(batch.column(n))
            for lo, hi in A.slices(offsets):
                raw, at = buf[offsets[lo] : offsets[hi]].tobytes(), (offsets[lo : hi + 1] - offsets[lo]).tolist()
                texts = [raw[s:e] for s, e in zip(at[:-1], at[1:])]
                ids, ends = own.encode_all(texts)
                columns = [_list(ids, ends)]
                if spans:
                    columns += [_list(x.astype(np.int32), ends) for x in own.spans_all(texts, ids, ends)]
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns[:n], *columns], names=schema.names)

    from pyspark.sql import types as T

    schema = T.StructType([*(docs.schema[c] for c in names), *(T.StructField(c, T.ArrayType(T.IntegerType())) for c in made)])
    return docs.select(*(F.col(f"`{c}`") for c in names), F.col(text).cast("string").alias("__text")).mapInArrow(A.released(run), schema)


def decode_ids(rows: DataFrame, model: bytes, *, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """All columns of every row and the text of its ids; null and empty lists give an empty text. `to` replaces a column of that name."""
    names = [c for c in rows.columns if c != to]
    where = names.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            lists = batch.column(where)
            sizes = np.append(0, np.cumsum(np.asarray(lists.value_lengths().fill_null(0)))).astype(np.int64)
            flat = lists.flatten().to_numpy()
            for lo, hi in A.slices(sizes, A.SLICE_BYTES // 4):
                body, offsets = own.decode(flat[sizes[lo] : sizes[hi]], sizes[lo : hi + 1] - sizes[lo])
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns, A.string_array(body, offsets)], names=[*names, to])

    from pyspark.sql import types as T

    schema = T.StructType([*(rows.schema[c] for c in names), T.StructField(to, T.StringType())])
    return rows.select(*(F.col(f"`{c}`") for c in names)).mapInArrow(A.released(run), schema)
