"""Content-defined anchors: which windows of a text must be compared with which.

Every window of ``window`` bytes is named by the smallest hash among its grams of
``GRAM`` bytes. Equal windows have equal names, so windows meet by name alone.
Neighbouring windows mostly share their gram; a run of them is one segment.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

GRAM = 64
# A hash and a place share one number, so that a minimum is also its leftmost place.
PLACE_BITS = 24
LONGEST = (1 << PLACE_BITS) - 1
# Bytes of a text that are looked at together.
PART = 2 << 20

_TABLE = np.random.default_rng(20_240_229).integers(0, 1 << 63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """The first n powers of a base modulo 2^64, kept at the largest size asked for."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        factors = np.full(max(n, 1 << 16), base, np.uint64)
        factors[0] = 1
        known = _powers[base] = np.cumprod(factors, dtype=np.uint64)
    return known[:n]


def gram_hashes(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """A 64-bit hash of each gram of ``size`` bytes, by differences of one running sum."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * powers(_BASE, len(data)), out=sums[1:], dtype=np.uint64)
    x = (sums[size:] - sums[:-size]) * powers(_BACK, len(data) + 1 - size)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(27))


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbouring values: of a block's tail and the next block's head."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    head = np.minimum.accumulate(grid, axis=1).ravel()
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[: n - width + 1], head[width - 1 : n])


@dataclass(frozen=True)
class Segments:
    """Runs of windows with one anchor: the text they lie in, their first window, how many, and the anchor's hash."""

    text: np.ndarray
    start: np.ndarray
    count: np.ndarray
    name: np.ndarray


def segments(texts: list[bytes], window: int) -> Segments:
    """All segments of the texts; a text shorter than a window has none.

    Long texts are cut into overlapping parts, which may end a run early but lose no window.
    """
    if any(len(t) > PART for t in texts):
        parts = [(i, at) for i, t in enumerate(texts) for at in range(0, max(len(t) - window + 1, 1), PART - window + 1)]
        found = [segments([texts[i][at : at + PART]], window) for i, at in parts]
        shifted = [(np.full(len(f.start), i), f.start + at, f.count, f.name) for (i, at), f in zip(parts, found, strict=True)]
        return Segments(*[np.concatenate(c) for c in zip(*shifted, strict=True)])
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) > LONGEST:
        raise ValueError("too many bytes at once")
    empty = np.zeros(0, np.int64)
    if len(data) < window:
        return Segments(empty, empty, empty, empty)
    mask = np.uint64(LONGEST)
    hashes = gram_hashes(data)
    keyed = (hashes & ~mask) | np.arange(len(hashes), dtype=np.uint64)
    anchor = (window_minima(keyed, window - GRAM + 1) & mask).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    first = np.arange(len(anchor))
    inside = owner[first] == owner[first + window - 1]
    start = inside.copy()
    start[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    # A window that begins another text begins another run too, though its anchor may be the same place.
    start[1:] |= inside[1:] & (owner[first[1:]] != owner[first[:-1]])
    at = np.flatnonzero(start)
    runs = np.cumsum(start) - 1
    count = np.bincount(runs[inside], minlength=len(at))
    text = owner[at]
    begin = np.cumsum(sizes) - sizes
    return Segments(text, at - begin[text], count, hashes[anchor[at]].view(np.int64))
