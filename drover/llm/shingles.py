"""Hashed sets of word shingles and their one-permutation signatures."""

from __future__ import annotations

import hashlib

import numpy as np

from drover.llm.base import PieceHash, mix64

BANDS, ROWS = 24, 4
BINS = BANDS * ROWS

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_STEP = np.uint64(0x9FB21C651E98DF25)
_hash = PieceHash(256)


def word_hashes(text: str) -> np.ndarray:
    """One 64-bit hash per word of a whole text, A-Z in lower case."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)
    inside = np.concatenate(([False], ~_BLANK[raw], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, stops = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    return mix64(_hash(raw, starts, stops))


def shingles(text: str | None, width: int) -> np.ndarray:
    """The distinct shingles of ``width`` words as ascending hashes. Fewer words make one
    shingle of all; no words make none."""
    words = word_hashes(text) if text else np.zeros(0, np.uint64)
    if not len(words):
        return words
    n = max(1, len(words) - width + 1)
    h = np.full(n, min(width, len(words)), np.uint64)
    for i in range(min(width, len(words))):
        h = mix64(h * _STEP + words[i : i + n])
    return np.unique(h)


def digest(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def _attempts() -> np.ndarray:
    """Row i lists the bins that an empty bin i tries to copy, the same for all documents."""
    i, k = np.meshgrid(np.arange(BINS, dtype=np.uint64), np.arange(64, dtype=np.uint64), indexing="ij")
    return (mix64(i * np.uint64(1 << 20) + k + np.uint64(77)) % np.uint64(BINS)).astype(np.int64)


_TRIES = _attempts()


def signature(found: np.ndarray) -> np.ndarray:
    """One permutation, split into bins: the least hash of each bin. An empty bin copies the
    bin that a hash of (bin, attempt) names, trying on until that one is not empty."""
    high = (found >> np.uint64(32)).astype(np.int64)
    bins = (high * BINS) >> 32
    first = np.flatnonzero(np.concatenate(([True], bins[1:] != bins[:-1])))
    out = np.zeros(BINS, np.uint32)
    filled = np.zeros(BINS, bool)
    out[bins[first]] = (mix64(found[first]) >> np.uint64(32)).astype(np.uint32)
    filled[bins[first]] = True
    empty = np.flatnonzero(~filled)
    for k in range(_TRIES.shape[1]):
        if not len(empty):
            return out
        source = _TRIES[empty, k]
        hit = filled[source]
        out[empty[hit]] = out[source[hit]]
        empty = empty[~hit]
    # So few bins are filled that no attempt met one: take them in turn, from the bin's own place.
    full = np.flatnonzero(filled)
    out[empty] = out[full[np.searchsorted(full, empty) % len(full)]]
    return out


def bands(sig: np.ndarray) -> np.ndarray:
    """One hash per band, different for equal values in different bands."""
    h = np.arange(1, BANDS + 1, dtype=np.uint64)
    for part in sig.reshape(BANDS, ROWS).T:
        h = mix64(h * _STEP + part.astype(np.uint64))
    return h.astype(np.int64)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)
