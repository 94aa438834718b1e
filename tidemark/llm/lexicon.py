"""Folding of disguised letters, and a weighted lexicon matched by one automaton."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick

# Letters of other scripts that look like Latin ones, and digits and signs that stand for letters.
HOMOGLYPHS = {
    "а": "a", "ӑ": "a", "α": "a", "ɑ": "a", "в": "b", "β": "b", "с": "c", "ϲ": "c", "ԁ": "d", "ɗ": "d", "е": "e", "ё": "e", "ε": "e",
    "ҽ": "e", "ɡ": "g", "һ": "h", "н": "h", "і": "i", "ї": "i", "ι": "i", "ı": "i", "ј": "j", "к": "k", "κ": "k", "ӏ": "l", "м": "m",
    "μ": "m", "п": "n", "η": "n", "о": "o", "ο": "o", "σ": "o", "ө": "o", "р": "p", "ρ": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t",
    "τ": "t", "υ": "u", "ս": "u", "ѵ": "v", "ν": "v", "ѡ": "w", "ω": "w", "ԝ": "w", "х": "x", "χ": "x", "у": "y", "γ": "y", "ʏ": "y", "ᴢ": "z",
}
SIGNS = {"0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "l", "|": "l"}
# One letter for those that one digit can stand for.
MERGED = {"i": "l", "ı": "l"}
# Characters that are not seen at all, so that they cannot break a word up.
INVISIBLE = (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)


def _table() -> dict[int, str | None]:
    table: dict[int, str | None] = {c: " " for c in range(128) if not chr(c).isalnum()}
    table |= {c: chr(c - 0xFEE0).lower() for c in range(0xFF01, 0xFF5F)}  # full-width forms
    table |= {ord(k): v for k, v in {**HOMOGLYPHS, **SIGNS}.items()}
    table |= {ord(k.upper()): v for k, v in HOMOGLYPHS.items() if len(k.upper()) == 1}
    table |= {0xFEE0 + ord(k): v for k, v in SIGNS.items()}
    table |= {ord(k): v for k, v in MERGED.items()}
    for code, value in table.items():
        table[code] = MERGED.get(value, value)
    return table | dict.fromkeys(INVISIBLE)


FOLD = _table()


def fold_text(text: str) -> str:
    """Lower case, look-alikes and digits as letters, ASCII punctuation as spaces; words keep one space on each side at least."""
    return f" {text.lower().translate(FOLD)} "


class Key:
    """What an automaton is made of, hashed once."""

    def __init__(self, parts: tuple[tuple[str, ...], tuple[str, ...]]):
        self.parts, self._hash = parts, hash(parts)

    def __hash__(self) -> int:
        return self._hash

    def __eq__(self, other: object) -> bool:
        return self is other or (isinstance(other, Key) and self._hash == other._hash and self.parts == other.parts)

    def __reduce__(self):  # text hashes differ between processes
        return Key, (self.parts,)


@dataclass(frozen=True)
class Lexicon:
    """Folded entries with weights; an entry begins with a space, and ends with one if it is a whole word.

    A hit inside a hit of an ``exceptions`` phrase does not count. ``scale`` turns
    the two length-normalised sums into log odds.
    """

    weights: Mapping[str, float]
    exceptions: Sequence[str] = ()
    scale: tuple[float, float, float] = (-3.0, 1.0, 1.0)
    key: Key = field(init=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "key", Key((tuple(sorted(self.weights)), tuple(sorted(self.exceptions)))))

    def hits(self, folded: str) -> list[tuple[int, int, str]]:
        """Entries found (start, end, entry), the longest at each start, without those inside an exception."""
        automaton = _automaton(self.key)
        if automaton is None:
            return []
        found: dict[int, tuple[int, str]] = {}
        spared: list[tuple[int, int]] = []  # in order of their ends; starts rise with them once inner ones are left out
        for last, (entry, exception) in automaton.iter(folded):
            start, end = last + 1 - len(entry), last + 1
            if exception:
                while spared and spared[-1][0] >= start:
                    spared.pop()
                spared.append((start, end))
            if entry in self.weights and found.get(start, (0, ""))[0] < end:
                found[start] = end, entry
        return [(s, e, entry) for s, (e, entry) in sorted(found.items()) if not _inside(s, e, spared)]


def _inside(start: int, end: int, spans: list[tuple[int, int]]) -> bool:
    """Whether one of the spans (both ends rising) holds a hit: the last that begins at or before it reaches furthest."""
    at = bisect_right(spans, start, key=lambda s: s[0]) - 1
    return at >= 0 and end <= spans[at][1]


@lru_cache(maxsize=4)
def _automaton(key: Key) -> ahocorasick.Automaton | None:
    entries, exceptions = key.parts
    automaton = ahocorasick.Automaton()
    for entry in entries:
        automaton.add_word(entry, (entry, entry in exceptions))
    for phrase in exceptions:
        automaton.add_word(phrase, (phrase, True))
    if not len(automaton):
        return None
    automaton.make_automaton()
    return automaton
