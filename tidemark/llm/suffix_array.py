"""Suffix arrays of many sequences at once, by prefix doubling over only what is still tied."""

from __future__ import annotations

import numpy as np


def suffix_ranks(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array of ``symbols``, and ranks by the first 1, 2, 4, ... symbols.

    The last symbol must occur nowhere else. A rank is the place of the first
    suffix of its group, so what is settled keeps its number.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    sorted_symbols = symbols[order]
    first = np.ones(n, bool)
    first[1:] = sorted_symbols[1:] != sorted_symbols[:-1]
    starts = np.flatnonzero(first)
    group = np.repeat(starts, np.diff(np.append(starts, n)))
    rank = np.empty(n, np.int64)
    rank[order] = group
    levels = [rank.astype(np.int32)]
    # Places in the order whose suffixes are still tied with a neighbour.
    open_ = np.flatnonzero(~(first & np.append(first[1:], True)))
    step = 1
    while len(open_):
        at = order[open_]
        key = rank[at] * (n + 1) + rank[np.minimum(at + step, n - 1)]
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[open_] = at
        new_first = np.ones(len(at), bool)
        new_first[1:] = key[1:] != key[:-1]
        starts = np.flatnonzero(new_first)
        rank[at] = np.repeat(open_[starts], np.diff(np.append(starts, len(at))))
        levels.append(rank.astype(np.int32))
        alone = new_first & np.append(new_first[1:], True)
        open_ = open_[~alone]
        step *= 2
    return order, levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """The longest common prefix of each suffix in the order with the one before it (0 for the first)."""
    n = len(order)
    lengths = np.zeros(n, np.int64)
    tied = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
    a, b = order[tied - 1], order[tied]
    found = np.zeros(len(tied), np.int64)
    for t in range(len(levels) - 1, -1, -1):
        rank = levels[t]
        same = rank[np.minimum(a + found, n - 1)] == rank[np.minimum(b + found, n - 1)]
        found += same.astype(np.int64) << t
    lengths[tied] = found
    return lengths


def longest_repeats(symbols: np.ndarray) -> np.ndarray:
    """For each place, the length of the longest string that starts there and also somewhere else."""
    order, levels = suffix_ranks(symbols)
    before = common_prefixes(order, levels)
    best = np.zeros(len(symbols), np.int64)
    best[order] = np.maximum(before, np.append(before[1:], 0))
    return best


def covered(lengths: np.ndarray, starts: np.ndarray | None = None) -> np.ndarray:
    """Which places lie in a span that begins at some place with the length given there."""
    n = len(lengths)
    at = np.flatnonzero(lengths) if starts is None else starts
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, at, 1)
    np.subtract.at(change, at + lengths[at], 1)
    return np.cumsum(change[:-1]) > 0
