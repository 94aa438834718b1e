"""A subword model of merges by score: its file format, normalisation with source alignment, encoding and decoding.

Small helpers for one document in one task; Spark deals the documents out
(``sentencepiece.py``).
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

# Fixed values of the file format.
SPACE_MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MERGES = 2
UNKNOWN_SURFACE = " ⁇ "
REPLACEMENT = "�"
NO_MERGE = 1 << 40

# Words kept with their pieces in a task: when as many are new, those not used since the last time go.
CACHE_WORDS = 250_000
# Words above this length are merged with a heap, so a long text without spaces takes n log n steps.
SHORT = 40


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and contents of a protocol-buffer message's fields."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        if key & 7 == 0:
            value, at = _varint(data, at)
        else:
            size, at = {1: (8, at), 5: (4, at)}.get(key & 7) or _varint(data, at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


@dataclass
class CharMap:
    """Longest-prefix replacement through a compiled double-array trie."""

    units: np.ndarray
    strings: bytes

    @classmethod
    def read(cls, blob: bytes) -> CharMap | None:
        if not blob:
            return None
        size = struct.unpack_from("<I", blob)[0]
        return cls(np.frombuffer(blob[4 : 4 + size], "<u4"), blob[4 + size :])

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """The replacement of the longest rule that starts at ``at``, and the bytes it takes."""
        units, found = self.units, None
        node = self._child(int(units[0]))
        for end in range(at, len(data)):
            node ^= data[end]
            if node >= len(units):
                break
            unit = int(units[node])
            if unit & 0x800000FF != data[end]:
                break
            node ^= self._child(unit)
            if unit >> 8 & 1:
                start = int(units[node]) & 0x7FFFFFFF
                found = self.strings[start : self.strings.index(b"\0", start)], end + 1 - at
        return found

    @staticmethod
    def _child(unit: int) -> int:
        return unit >> 10 << ((unit & 512) >> 6)


class PieceModel:
    """Parsed from the bytes of a model file. Only models of merges are read, without user-defined or unused pieces."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        self.byte_fallback = self.suffix_mark = False
        self.dummy_prefix = self.trim = self.escape = True
        charmap, model_type = b"", 1
        for number, value in _fields(data):
            if number == 1:
                own = dict(_fields(value))
                self.pieces.append(own[1].decode())
                scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                self.kinds.append(own.get(3, NORMAL))
            elif number == 2:
                spec = dict(_fields(value))
                model_type = spec.get(3, 1)
                self.suffix_mark = bool(spec.get(24, 0))
                self.byte_fallback = bool(spec.get(35, 0))
            elif number == 3:
                spec = dict(_fields(value))
                charmap = spec.get(2, b"")
                self.dummy_prefix, self.trim, self.escape = (bool(spec.get(n, 1)) for n in (3, 4, 5))
        if model_type != MERGES or {USER, UNUSED} & set(self.kinds) or self.suffix_mark:
            raise ValueError("not a plain model of merges")
        self.charmap = CharMap.read(charmap)
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] == NORMAL}
        self.scores = {p: scores[i] for p, i in self.ids.items()}
        self.unknown = self.kinds.index(UNKNOWN)
        self.bytes = {int(p[1:-1], 16): i for i, p in enumerate(self.pieces) if self.kinds[i] == BYTE}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        # No piece has the mark after another character: then merges never cross from one word to the next.
        apart = not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in self.ids)
        self.words = re.compile(f"{SPACE_MARK}*[^{SPACE_MARK}]+|{SPACE_MARK}+" if apart else r"(?s).+").findall
        self.surface = [self._surface(i) for i in range(len(self.pieces))]
        self.is_byte = np.array([k == BYTE for k in self.kinds])
        self.forget()
        self._pair_table()

    def forget(self) -> None:
        """Drops the words kept, about 100 MB when there are as many as may be."""
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _surface(self, i: int) -> str:
        if self.kinds[i] in (CONTROL, BYTE):
            return ""
        return UNKNOWN_SURFACE if self.kinds[i] == UNKNOWN else self.pieces[i].replace(SPACE_MARK, " ")

    # Normalisation

    def normalise(self, text: str) -> tuple[str, np.ndarray | None]:
        """The text the merges see, and the source byte at which each of its bytes starts (None: character for character)."""
        if not text:
            return "", np.zeros(1, np.int64)
        if self.charmap is None and not self.trim:
            inner = text.replace(" ", SPACE_MARK) if self.escape else text
            return (SPACE_MARK if self.dummy_prefix else "") + inner, None
        return self._normalise_by_rule(text.encode())

    def _normalise_by_rule(self, data: bytes) -> tuple[str, np.ndarray]:
        mark = SPACE_MARK.encode() if self.escape else b" "
        out, source = bytearray(), []
        at, trim = 0, self.trim
        body = bytearray()
        starts: list[int] = []
        while at < len(data):
            new, size = self._prefix(data, at)
            while trim and new.startswith(b" "):
                new = new[1:]
            for byte in new:
                piece = mark if byte == 32 else bytes([byte])
                body += piece
                starts += [at] * len(piece)
            if new:
                trim = self.trim and new.endswith(b" ")
            at += size
        end = len(data)
        while self.trim and body.endswith(mark):
            end = starts[len(body) - len(mark)]
            del body[-len(mark) :], starts[-len(mark) :]
        if self.dummy_prefix and body:
            first = starts[0] if starts else 0
            out += mark
            source += [first] * len(mark)
        out += body
        return out.decode(), np.array(source + starts + [end], np.int64)

    def _prefix(self, data: bytes, at: int) -> tuple[bytes, int]:
        found = self.charmap.longest(data, at) if self.charmap else None
        if found:
            return found
        size = 1
        while at + size < len(data) and data[at + size] & 0xC0 == 0x80:
            size += 1
        return data[at : at + size], size

    # Encoding

    def _pair_table(self) -> None:
        """All pairs of symbols that merge: sorted keys, with the merge's rank and symbol. Symbols are pieces, then other characters."""
        others = sorted({c for p in self.ids for c in p} - self.ids.keys())
        symbols = self.ids | {c: len(self.pieces) + i for i, c in enumerate(others)}
        self.symbol_count = len(self.pieces) + len(others) + 1
        ranks = {score: r for r, score in enumerate(sorted(set(self.scores.values()), reverse=True))}
        pairs = {}
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                if piece[:cut] in symbols and piece[cut:] in symbols:
                    pairs[symbols[piece[:cut]] * self.symbol_count + symbols[piece[cut:]]] = ranks[self.scores[piece]], i
        self.pair_keys = np.array(sorted(pairs), np.int64)
        found = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64).reshape(-1, 2)
        self.pair_rank, self.pair_symbol = found[:, 0], found[:, 1]
        self.char_symbol = np.full(0x110000, self.symbol_count - 1, np.int64)
        for char, i in symbols.items():
            if len(char) == 1:
                self.char_symbol[ord(char)] = i
        self.byte_ids = np.array([self.bytes.get(b, self.unknown) for b in range(256)], np.int64)

    def _pairs_at(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and symbol of the merge of each pair; the rank is ``NO_MERGE`` where there is none."""
        if not len(self.pair_keys):
            return np.full(len(left), NO_MERGE), left
        keys = left * self.symbol_count + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_rank[at], NO_MERGE), self.pair_symbol[at]

    def _merge_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of all words after their merges, the characters each takes, and the word it is in.

        In each round every word that still has a pair makes its best merge, the
        leftmost of equal ones.
        """
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        symbol, size = self.char_symbol[chars], np.ones(len(chars), np.int64)
        place = np.arange(len(chars))
        done: list[tuple[np.ndarray, ...]] = []
        rank = np.full(len(chars), NO_MERGE)
        merged = np.zeros(len(chars), np.int64)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner], merged[inner] = self._pairs_at(symbol[inner], symbol[inner + 1])
        while len(word):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            count = np.diff(np.append(first, len(word)))
            best = np.repeat(np.minimum.reduceat(rank, first), count)
            over = best == NO_MERGE
            if over.any():
                done.append((place[over], symbol[over], size[over], word[over]))
                place, symbol, size, word, rank, merged, best = (x[~over] for x in (place, symbol, size, word, rank, merged, best))
                if not len(word):
                    break
            at = np.flatnonzero(rank == best)
            at = at[np.diff(word[at], prepend=-1) != 0]
            symbol[at] = merged[at]
            size[at] += size[at + 1]
            stay = np.ones(len(word), bool)
            stay[at + 1] = False
            place, symbol, size, word, rank, merged = (x[stay] for x in (place, symbol, size, word, rank, merged))
            at -= np.arange(len(at))
            for where in (at, at[(at > 0)] - 1):
                rank[where] = NO_MERGE
                paired = where[where + 1 < len(word)]
                paired = paired[word[paired] == word[paired + 1]]
                rank[paired], merged[paired] = self._pairs_at(symbol[paired], symbol[paired + 1])
        if not done:
            return (np.zeros(0, np.int64),) * 3
        place, symbol, size, word = (np.concatenate(c) for c in zip(*done, strict=True))
        by = np.argsort(place)
        return symbol[by], size[by], word[by]

    def _merge_long(self, parts: list[str]) -> list[str]:
        n, scores = len(parts), self.scores
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list[tuple[float, int, int, str]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and (score := scores.get(parts[a] + parts[b])) is not None:
                heapq.heappush(heap, (-score, a, b, parts[a] + parts[b]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, a, b, merged = heapq.heappop(heap)
            # A side that has merged since then makes the pair stale.
            if not parts[a] or not parts[b] or right[a] != b or parts[a] + parts[b] != merged:
                continue
            parts[a], parts[b] = merged, ""
            right[a] = right[b]
            if right[b] >= 0:
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        return [p for p in parts if p]

    def _learn(self, words: list[str]) -> None:
        """Adds words to the cache: for each piece its id, and where it ends in characters from the word's start."""
        short = [w for w in words if len(w) <= SHORT]
        symbol, size, word = self._merge_words(short)
        parts = [(short, symbol, size, word)]
        for long in (w for w in words if len(w) > SHORT):
            pieces = self._merge_long(list(long))
            symbols = [self.ids.get(p, self.symbol_count - 1) for p in pieces]
            parts.append(([long], np.array(symbols), np.array([len(p) for p in pieces]), np.zeros(len(pieces), np.int64)))
        for own, symbol, size, word in parts:
            if own:
                self._store(own, symbol, size, word)

    def _store(self, words: list[str], symbol: np.ndarray, size: np.ndarray, word: np.ndarray) -> None:
        ends = np.cumsum(size)
        base = np.cumsum([0, *map(len, words)])[word]
        unknown = symbol >= len(self.pieces)
        ids = np.where(unknown, self.unknown, symbol)
        repeat = np.ones(len(ids), np.int64)
        stop = ends - base
        if unknown.any() and self.byte_fallback:
            # A character that is no piece is written as its bytes: all but the last are empty pieces at its start.
            raw = [c.encode() for c in self._chars_at(words, ends[unknown] - 1)]
            repeat[unknown] = [len(r) for r in raw]
            taken = np.repeat(np.arange(len(ids)), repeat)
            last = np.append(taken[1:] != taken[:-1], True)
            stop = stop[taken] - (~last)
            ids = ids[taken]
            ids[unknown[taken]] = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
            word = word[taken]
        elif unknown.any():
            # A run of unknown characters is one piece.
            last = ~(unknown[:-1] & unknown[1:] & (word[:-1] == word[1:]))
            keep = np.append(last, True)
            ids, stop, word = ids[keep], stop[keep], word[keep]
        data = np.column_stack([ids, stop]).astype(np.int32).tobytes()
        limits = (8 * np.searchsorted(word, np.arange(len(words) + 1))).tolist()
        self.cache.update(zip(words, [data[a:b] for a, b in zip(limits, limits[1:], strict=False)], strict=True))

    @staticmethod
    def _chars_at(words: list[str], places: np.ndarray) -> list[str]:
        text = "".join(words)
        return [text[i] for i in places.tolist()]

    def encode_many(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, the span of source bytes of each piece (start, end exclusive), and where each text's pieces begin."""
        normal = [self.normalise(t) for t in texts]
        words = [self.words(n) for n, _ in normal]
        if len(self.cache) > CACHE_WORDS:
            self.cache, self.older = {}, self.cache
        new = {w for own in words for w in own} - self.cache.keys()
        self.cache.update({w: self.older[w] for w in new & self.older.keys()})
        self._learn(list(new - self.older.keys()))
        entries = [self.cache[w] for own in words for w in own]
        found = np.frombuffer(b"".join(entries), np.int32).reshape(-1, 2)
        counts = np.fromiter(map(len, entries), np.int64, len(entries)) >> 3
        ids, stops = found[:, 0], found[:, 1].astype(np.int64)
        # Ends in characters, counted over all texts.
        last = np.cumsum(counts) - 1
        sizes = stops[last] if len(last) else last
        stops += np.repeat(np.cumsum(sizes) - sizes, counts)
        per_text = np.add.reduceat(np.append(counts, 0), np.minimum(np.cumsum([0, *map(len, words)])[:-1], len(counts))) if texts else counts
        per_text = np.where([len(w) > 0 for w in words], per_text, 0) if texts else per_text
        offsets = np.concatenate([[0], np.cumsum(per_text)]).astype(np.int64)
        places = self._places(texts, normal)
        text = np.repeat(np.arange(len(texts)), per_text)
        # Each text has one place more than characters: the end of its last one.
        ends = places[stops + text] if len(stops) else stops
        starts = np.zeros(len(ends), np.int64)
        starts[1:] = ends[:-1]
        heads = offsets[:-1][per_text > 0]
        at = np.cumsum([0, *[len(n) + 1 for n, _ in normal]])[:-1]
        starts[heads] = places[at[per_text > 0]] if len(heads) else 0
        return ids, starts, ends, offsets

    def _places(self, texts: Sequence[str], normal: list[tuple[str, np.ndarray | None]]) -> np.ndarray:
        """For each character of each normalised text, and its end, the source byte."""
        out = []
        for text, (own, source) in zip(texts, normal, strict=True):
            if source is not None:
                raw = np.frombuffer(own.encode(), np.uint8)
                out.append(source[np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))])
                continue
            # Characters stand one for one; one mark may come before them.
            added = len(own) - len(text)
            if text.isascii():
                heads = np.arange(len(text) + 1)
            else:
                raw = np.frombuffer(text.encode(), np.uint8)
                heads = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
            out.append(np.concatenate([np.zeros(added, np.int64), heads]))
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and the span of source bytes of each piece (start, end exclusive)."""
        return self.encode_many([text])[:3]

    # Decoding

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: marks as spaces, the leading one dropped, runs of byte pieces as UTF-8."""
        listed = ids.tolist()
        surface = self.surface
        if not self.is_byte[ids].any():
            text = "".join([surface[i] for i in listed])
        else:
            parts: list[str] = []
            run = bytearray()
            for i in listed:
                byte = self.byte_of.get(i)
                if byte is not None:
                    run.append(byte)
                    continue
                if run:
                    parts.append(_utf8(bytes(run)))
                    run.clear()
                parts.append(surface[i])
            if run:
                parts.append(_utf8(bytes(run)))
            text = "".join(parts)
        first = next((i for i in listed if self.kinds[i] != CONTROL), None)
        strip = first is not None and self.kinds[first] == NORMAL and self.pieces[first].startswith(SPACE_MARK)
        return text[1:] if strip and (self.dummy_prefix or self.trim) else text


def _utf8(raw: bytes) -> str:
    """Bytes as text; each byte that is not part of a whole character is one replacement character."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(raw):
            for size in (1, 2, 3, 4):
                try:
                    out.append(raw[at : at + size].decode())
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append(REPLACEMENT)
                size = 1
            at += size
        return "".join(out)


@lru_cache(maxsize=2)
def load(data: bytes) -> PieceModel:
    """One parsed model for each file content in a process."""
    return PieceModel(data)
