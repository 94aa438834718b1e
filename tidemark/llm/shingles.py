"""Hashed sets of word shingles, for a batch of documents in one task."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np

from .anchors import powers

# Words lie between these bytes.
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
# Odd numbers for bytes, drawn once; places in a word are told apart by powers of an odd base.
_TABLE = np.random.default_rng(20_240_301).integers(0, 1 << 63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0xD6E8FEB86659FD93
_BACK = pow(_BASE, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word starts, and a 64-bit hash of it: a difference of one running sum, shifted to the word's start."""
    inner = ~_SPACES[data]
    edges = np.flatnonzero(np.diff(inner, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * powers(_BASE, len(data)), out=sums[1:], dtype=np.uint64)
    hashes = (sums[ends] - sums[starts]) * powers(_BACK, len(data) + 1)[starts]
    return starts, _mix(hashes + (ends - starts).astype(np.uint64))


def shingle_sets(texts: Sequence[bytes], size: int) -> list[np.ndarray]:
    """For each text, sorted distinct 64-bit hashes of its shingles of ``size`` words.

    With fewer words there is one of the whole sequence, without words none. A-Z count as a-z.
    """
    data = np.frombuffer(b" ".join(texts).lower(), np.uint8)
    limits = np.cumsum([len(t) + 1 for t in texts])
    starts, words = word_hashes(data)
    bounds = np.concatenate([[0], np.searchsorted(starts, limits)]) if len(texts) else np.zeros(1, np.int64)
    full = max(len(words) - size + 1, 0)
    total = np.full(full, size, np.uint64)
    for i in range(size):
        total = _mix(total + words[i : i + full])
    total = total.view(np.int64)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(total[a : b - size + 1]))
        elif b > a:
            short = np.full(1, b - a, np.uint64)
            for i in range(a, b):
                short = _mix(short + words[i : i + 1])
            out.append(short.view(np.int64))
        else:
            out.append(np.zeros(0, np.int64))
    return out


def set_name(values: np.ndarray, salt: int = 0) -> tuple[int, int]:
    """A set's name and a check of it, 64 bits each: sets that share a name but not the check need another salt."""
    digest = hashlib.blake2b(values.tobytes(), digest_size=16, key=b"%d" % salt).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def _bits(size: int) -> int:
    """Leading bits of a hash that a compact set of this size keeps: about 16 places for each element at least."""
    return max(int(size).bit_length() + 5, 8)


def compact(values: np.ndarray) -> bytes:
    """A sorted set's leading bits as gaps of one byte (255 stands for a gap that goes on): about a byte for each element."""
    places = (values.astype(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(64 - _bits(len(values)))
    gaps = np.diff(places.astype(np.int64), prepend=0)
    long = gaps // 255
    out = np.full(len(gaps) + int(long.sum()), 255, np.uint8)
    out[np.cumsum(long + 1) - 1] = gaps % 255
    return out.tobytes()


def _places(data: bytes) -> np.ndarray:
    gaps = np.frombuffer(data, np.uint8)
    return np.cumsum(gaps, dtype=np.int64)[gaps < 255]


def most_common(a: bytes, b: bytes) -> int:
    """An upper bound of the overlap of two compacted sets, rarely above it."""
    x, y = _places(a), _places(b)
    shift = _bits(len(x)) - _bits(len(y))
    x, y = (x >> shift if shift > 0 else x), (y >> -shift if shift < 0 else y)
    (x, nx), (y, ny) = np.unique(x, return_counts=True), np.unique(y, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    return int(np.minimum(nx[i], ny[j]).sum())
