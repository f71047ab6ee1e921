"""Word shingles of a text as sorted 64-bit hashes, and their MinHash signatures, in numpy."""

from __future__ import annotations

import numpy as np

from tidelog.llm.perfect_hash import mix
from tidelog.llm.text import PLAIN

U = np.uint64
SEGMENT = 1 << 20  # bytes of a text that are hashed at once; longer texts are cut between words
BYTE = mix(np.arange(1, 257, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
FACTOR = 0xD6E8FEB86659FD93

_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 64), FACTOR, np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=np.uint64)
    return _powers


def _hash_words(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    inside = np.concatenate(([False], raw != 32, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    letters = BYTE[raw[np.repeat(starts, lengths) + at]] * powers(int(lengths.max()))[at]
    return mix(np.add.reduceat(letters, np.cumsum(lengths) - lengths) + lengths.astype(np.uint64))


def word_hashes(text: bytes) -> np.ndarray:
    """One hash per word, in order: words are runs of other than [\\x20\\x09-\\x0D], A-Z lower-cased."""
    data, parts, start = text.translate(PLAIN), [], 0
    while len(data) - start > SEGMENT:
        end = data.find(b" ", start + SEGMENT)
        if end < 0:
            break
        parts.append(_hash_words(data[start:end]))
        start = end
    parts.append(_hash_words(data[start:]))
    return np.concatenate(parts)


def shingles(text: bytes, size: int) -> np.ndarray:
    """The sorted distinct hashes of runs of `size` words; of a shorter text, of all its words as one; else none."""
    words = word_hashes(text)
    n = len(words) - size + 1
    if not len(words):
        return words
    if n < 1:
        size, n, salt = len(words), 1, U(0xA5A5A5A5A5A5A5A5)
    else:
        salt = U(0)
    out = words[:n] ^ salt
    for i in range(1, size):
        out = mix(out * U(0x9E3779B97F4A7C15)) + words[i:n + i]
    return np.unique(mix(out))


class MinHash:
    """Signatures of `k` coordinates: the least value of k hash functions over a set."""

    def __init__(self, k: int, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.flips = draw.integers(0, 2**32, k, dtype=np.uint32)
        self.factors = draw.integers(0, 2**31, k, dtype=np.uint32) * np.uint32(2) + np.uint32(1)

    def sign(self, items: np.ndarray) -> np.ndarray:
        out = np.full(len(self.flips), 2**32 - 1, np.uint32)
        short = (items >> U(32)).astype(np.uint32)
        for at in range(0, len(short), 1024):
            x = (short[at:at + 1024, None] ^ self.flips) * self.factors
            x ^= x >> np.uint32(15)
            x *= np.uint32(0x2C1B3C6D)
            x ^= x >> np.uint32(13)
            np.minimum(out, x.min(axis=0), out=out)
        return out
