"""A SentencePiece model file: its pieces, its normaliser, and where texts may be cut without changing the result."""

from __future__ import annotations

import struct

import numpy as np
from sentencepiece import sentencepiece_model_pb2

from playbeat.llm import arrays as A

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class CharacterMap:
    """The compiled map of a normaliser: a double-array trie from byte strings to offsets into replacement strings."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if size else ()
        self.strings = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes]:
        """Length of the longest mapped prefix at a place, and its replacement; length 0 if there is none."""
        if not self.units:
            return 0, b""
        units, best, value = self.units, 0, 0
        step = lambda unit: (unit >> 10) << ((unit & (1 << 9)) >> 6)
        node = step(units[0])
        for i in range(at, len(text)):
            node ^= text[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & ((1 << 31) | 0xFF) != text[i]:
                break
            node ^= step(unit)
            if unit >> 8 & 1:
                best, value = i + 1 - at, units[node] & 0x7FFFFFFF
        return best, self.strings[value : self.strings.index(b"\0", value)] if best else b""


class Pieces:
    """Pieces with ids and scores, and the normaliser with its alignment to the source bytes."""

    def __init__(self, model: bytes):
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        kinds = {p.type for p in proto.pieces}
        if kinds & {USER_DEFINED, UNUSED} or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("models with user-defined or unused pieces, or space as a suffix, are not supported")
        self.names = [p.piece for p in proto.pieces]
        self.kinds = [p.type for p in proto.pieces]
        self.score = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        order = {s: i for i, s in enumerate(sorted(set(self.score.values()), reverse=True))}
        self.rank = {piece: order[s] for piece, s in self.score.items()}
        self.id = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.unknown = self.kinds.index(UNKNOWN)
        self.bytes = [-1] * 256
        for i, p in enumerate(proto.pieces):
            if p.type == BYTE:
                self.bytes[int(p.piece[1:-1], 16)] = i
        self.byte_fallback = proto.trainer_spec.byte_fallback
        self.unknown_surface = proto.trainer_spec.unk_surface or " ⁇ "
        rules = proto.normalizer_spec
        self.prefix, self.squeeze, self.escape = rules.add_dummy_prefix, rules.remove_extra_whitespaces, rules.escape_whitespaces
        self.map = CharacterMap(rules.precompiled_charsmap)
        #: Texts without the space symbol then only swap spaces for it.
        self.plain = not self.map.units and not self.squeeze and self.escape
        #: No piece holds a space symbol after another character, so nothing is merged across such a place.
        self.cuts = self.escape and not any(SPACE in p.lstrip(SPACE) for p in self.score)
        #: Neighbouring characters that some piece holds; nothing is merged across other pairs.
        self.pairs = {p[i : i + 2] for p in self.score for i in range(len(p) - 1)}

    def character(self, text: bytes, at: int) -> tuple[int, bytes]:
        """Source length and normal form of the longest prefix at a place."""
        size, out = self.map.longest(text, at)
        if size:
            return size, out
        lead = text[at]
        size = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        part = text[at : at + size]
        try:
            part.decode()
        except UnicodeDecodeError:
            return 1, "�".encode()
        return size, part

    def normalise(self, text: bytes) -> tuple[bytes, list[int]]:
        """Normal form and, for each of its bytes and its end, the source byte it comes from."""
        if not text:
            return b"", [0]
        space = SPACE.encode() if self.escape else b" "
        at, out, source = 0, bytearray(), []
        if self.squeeze:
            while at < len(text):
                size, form = self.character(text, at)
                if form != b" ":
                    break
                at += size
            if at == len(text):
                return b"", [at]

        def put(form: bytes, here: int) -> None:
            out.extend(form)
            source.extend([here] * len(form))

        if self.prefix:
            put(space, at)
        spaced = self.squeeze
        while at < len(text):
            size, form = self.character(text, at)
            while spaced and form.startswith(b" "):
                form = form[1:]
            if form:
                put(form.replace(b" ", space) if self.escape else form, at)
                spaced = self.squeeze and form.endswith(b" ")
            at += size
        if self.squeeze:
            while out.endswith(space):
                del out[-len(space) :]
                at = source[-len(space)]
                del source[-len(space) :]
        return bytes(out), [*source, at]

    def segments(self, text: str) -> list[str]:
        """Cuts a normalised text where no piece can cross, each segment with its leading space symbols."""
        if not self.cuts:
            return [text] if text else []
        parts = text.split(SPACE)
        if SPACE * 2 not in text:
            return ([parts[0]] if parts[0] else []) + [SPACE + p for p in parts[1:]]
        out, spaces = ([parts[0]] if parts[0] else []), ""
        for p in parts[1:]:
            spaces += SPACE
            if p:
                out.append(spaces + p)
                spaces = ""
        return out + [spaces] if spaces else out

    def strands(self, segment: str) -> list[str]:
        """Cuts a segment further, between characters that stand together in no piece."""
        pairs, out, start = self.pairs, [], 0
        for i in range(1, len(segment)):
            if segment[i - 1 : i + 1] not in pairs:
                out.append(segment[start:i])
                start = i
        out.append(segment[start:])
        return out


    def swaps(self, text: bytes) -> bool:
        """Whether the normal form only swaps spaces for the space symbol, with the prefix before it."""
        if not self.plain or SPACE.encode() in text:
            return False
        try:
            return text.decode() is not None
        except UnicodeDecodeError:  # the general way replaces such bytes
            return False

    def form(self, text: bytes) -> tuple[str, list[int] | None]:
        """Normal form of a text, and the source byte of each of its bytes, None where only spaces were swapped."""
        if self.swaps(text):
            form = text.decode().replace(" ", SPACE)
            return (SPACE + form if form and self.prefix else form), None
        form, source = self.normalise(text)
        return form.decode(), source

    def units(self, texts: list[bytes], long: int) -> tuple[list[str], np.ndarray]:
        """The parts of all texts in order, and the first part of each text (one more than texts).

        Parts are segments; one of more than `long` characters is cut into strands.
        """
        parts, first = [], [0]
        for text in texts:
            segments = self.segments(self.form(text)[0])
            if segments and max(map(len, segments)) > long:
                segments = [u for s in segments for u in ([s] if len(s) <= long else self.strands(s))]
            parts += segments
            first.append(len(parts))
        return parts, np.array(first)


class Table:
    """Whole numbers from 0 to whole numbers, for many keys at once: open addressing, at most a quarter full."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, none: int):
        self.none, bits = none, max(4, int(4 * len(keys)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, none, np.int64)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[slot[left]] < 0]
            put = free[np.unique(slot[free], return_index=True)[1]]
            self.keys[slot[put]], self.values[slot[put]] = keys[put], values[put]
            left = np.setdiff1d(left, put)
            slot[left] = slot[left] + 1 & self.last

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * A.BASE >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, `none` where it is not held."""
        slot = self._slot(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.values[slot], self.none)
        left = np.flatnonzero((held != keys) & (held >= 0))
        while len(left):
            slot[left] = slot[left] + 1 & self.last
            held = self.keys[slot[left]]
            same = held == keys[left]
            out[left[same]] = self.values[slot[left[same]]]
            left = left[~same & (held >= 0)]
        return out


class Memory:
    """Results of parts seen lately; two generations, of which the older one is dropped. A part met again stays.

    `make` works many different parts at once. A generation grows by at most the parts of one call beyond `most`.
    """

    def __init__(self, make, most: int = 1 << 17, longest: int = 64):
        self.make, self.most, self.longest, self.new, self.old = make, most, longest, {}, {}

    def all(self, parts: list[str]) -> list:
        """The result of every part; parts may repeat, and those not met lately are worked once."""
        if len(self.new) >= self.most:
            self.old, self.new = self.new, {}
        out = list(map(self.new.get, parts))
        lost = [i for i, x in enumerate(out) if x is None]
        if not lost:
            return out
        wanted = list(dict.fromkeys(map(parts.__getitem__, lost)))
        found = dict(zip(wanted, map(self.old.get, wanted)))
        fresh = [p for p, x in found.items() if x is None]
        found.update(zip(fresh, self.make(fresh)))
        for i in lost:
            out[i] = found[parts[i]]
        self.new.update(found if max(map(len, wanted)) <= self.longest else {p: x for p, x in found.items() if len(p) <= self.longest})
        return out
