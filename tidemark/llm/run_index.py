"""A run-length index of many byte strings, and the long matches between them.

The strings are sorted into a Burrows-Wheeler transform of which only the runs are
kept. Where a run begins, the place of its first suffix and that suffix's common
prefix with the one before are sampled; where it ends, the last suffix and its
common prefix with the next. Between samples nothing is stored: one step to the
right in the text shortens a match by one, so matching statistics stream from
sample to sample. In a repetitive collection the runs, and so the samples, are far
fewer than the bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Symbols are bytes plus one, and 0 between strings: 9 bits, seven to a word.
BITS, PACKED = 9, 7


def _join(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all strings, each followed by the separator, and how far each place is from its string's end."""
    sizes = np.array([len(s) for s in strings], np.int64)
    symbols = np.zeros(int(sizes.sum()) + len(strings), np.int64)
    ends = np.cumsum(sizes + 1) - 1
    inner = np.ones(len(symbols), bool)
    inner[ends] = False
    symbols[inner] = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64) + 1
    left = np.repeat(ends, sizes + 1) - np.arange(len(symbols))
    return symbols, left


def _sorted_suffixes(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in order, and ranks by the first 7, 14, 28, ... symbols."""
    n = len(symbols)
    padded = np.zeros(n + PACKED, np.int64)
    padded[:n] = symbols
    key = np.zeros(n, np.int64)
    for i in range(PACKED):
        key = (key << BITS) | padded[i : i + n]
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.ones(n, bool)
    first[1:] = key[1:] != key[:-1]
    rank = np.empty(n + 1, np.int64)
    starts = np.flatnonzero(first)
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    rank[n] = 0
    levels = [rank.astype(np.int32)]
    tied = np.flatnonzero(~(first & np.append(first[1:], True)))
    size = PACKED
    while len(tied):
        at = order[tied]
        # What has run past the end comes first, the shorter before the longer.
        key = rank[at] * (2 * n + 2) + np.where(at + size < n, rank[np.minimum(at + size, n)] + n + 1, n - at)
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[tied] = at
        new = np.ones(len(at), bool)
        new[1:] = key[1:] != key[:-1]
        starts = np.flatnonzero(new)
        rank[at] = np.repeat(tied[starts], np.diff(np.append(starts, len(at))))
        levels.append(rank.astype(np.int32))
        tied = tied[~(new & np.append(new[1:], True))]
        size *= 2
    return order, levels


def _common(a: np.ndarray, b: np.ndarray, symbols: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """The common prefix of the suffixes at ``a`` and ``b``, from ranks, then symbol by symbol."""
    n = len(symbols)
    found = np.zeros(len(a), np.int64)
    for t in range(len(levels) - 1, -1, -1):
        rank = levels[t]
        same = (rank[np.minimum(a + found, n)] == rank[np.minimum(b + found, n)]) & (np.maximum(a, b) + found < n)
        found += same.astype(np.int64) * (PACKED << t)
    padded = np.append(symbols, -1)
    live = np.ones(len(a), bool)
    for _ in range(PACKED - 1):
        x, y = np.minimum(a + found, n), np.minimum(b + found, n)
        live &= (padded[x] == padded[y]) & (x < n) & (y < n)
        found += live
    return found


@dataclass(frozen=True)
class RunIndex:
    """The transform's runs (first symbol and length), and samples at run starts and ends, in text order."""

    symbol: np.ndarray
    length: np.ndarray
    start_place: np.ndarray
    start_match: np.ndarray
    end_place: np.ndarray
    end_match: np.ndarray
    left: np.ndarray

    @classmethod
    def build(cls, strings: list[bytes]) -> RunIndex:
        symbols, left = _join(strings)
        n = len(symbols)
        order, levels = _sorted_suffixes(symbols)
        transform = symbols[order - 1]
        transform[order == 0] = 0
        begins = np.ones(n, bool)
        begins[1:] = transform[1:] != transform[:-1]
        # A suffix at the start of a string has no symbol before it: the next place cannot lean on it.
        begins |= transform == 0
        ends = np.append(begins[1:], True) | (transform == 0)
        begins[1:] |= ends[:-1]
        heads, tails = np.flatnonzero(begins), np.flatnonzero(ends)
        before = np.where(heads > 0, _common(order[np.maximum(heads - 1, 0)], order[heads], symbols, levels), 0)
        after = np.where(tails < n - 1, _common(order[tails], order[np.minimum(tails + 1, n - 1)], symbols, levels), 0)

        def in_text(places: np.ndarray, matches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            by = np.argsort(places)
            return places[by], matches[by]

        return cls(transform[heads], np.diff(np.append(heads, n)), *in_text(order[heads], before), *in_text(order[tails], after), left)

    def _stream(self, places: np.ndarray, matches: np.ndarray) -> np.ndarray:
        """A match at each place: that of the last sample at or before it, one shorter for each step since."""
        at = np.arange(len(self.left))
        sample = np.searchsorted(places, at, side="right") - 1
        return np.where(sample >= 0, matches[sample] + places[sample] - at, 0)

    def matching_statistics(self) -> np.ndarray:
        """For each place, the longest string that starts there, within its string, and also somewhere else."""
        longest = np.maximum(self._stream(self.start_place, self.start_match), self._stream(self.end_place, self.end_match))
        return np.clip(longest, 0, self.left)


def long_matches(strings: list[bytes], least: int) -> list[np.ndarray]:
    """For each string, the places at which a match of ``least`` bytes or more starts."""
    statistics = RunIndex.build(strings).matching_statistics()
    sizes = np.array([len(s) + 1 for s in strings], np.int64)
    begins = np.cumsum(sizes) - sizes
    return [np.flatnonzero(statistics[b : b + n] >= least) for b, n in zip(begins.tolist(), sizes.tolist(), strict=True)]
