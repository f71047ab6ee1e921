"""A minimal perfect hash function over 16-byte keys, by levels of collision-free bits."""

from __future__ import annotations

import numpy as np

SPREAD = 2.0  # bits per key of a level
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def halves(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


class PerfectHash:
    """Maps each of n distinct keys to its own number in 0 .. n-1, with about 3.7 bits a key.

    A level gives every key left over a place in a bit array and keeps those that are alone in theirs; the
    others go on to the next level. A key's number is the count of bits set before its own. Any other key
    maps to some number or to -1, so who looks up must compare a fingerprint.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        sizes = [0, *(int(bits.sum()) for bits in levels)]
        self.before = np.cumsum(sizes)[:-1]
        self.ranks = [np.cumsum(bits, dtype=np.int64) - 1 for bits in levels]

    @staticmethod
    def places(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = U((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))
        return (mix(a ^ mix(b + seed)) % U(size)).astype(np.int64)

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray) -> "PerfectHash":
        levels: list[np.ndarray] = []
        while len(a):
            size = int(len(a) * SPREAD) + 8
            at = cls.places(a, b, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = ~alone[at]
            a, b = a[left], b[left]
        return cls(levels)

    def index(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.full(len(a), -1, np.int64)
        left = np.arange(len(a))
        for level, bits in enumerate(self.levels):
            at = self.places(a[left], b[left], level, len(bits))
            hit = bits[at]
            out[left[hit]] = self.before[level] + self.ranks[level][at[hit]]
            left = left[~hit]
        return out

    def dump(self) -> bytes:
        sizes = np.array([len(self.levels), *(len(bits) for bits in self.levels)], "<i8").tobytes()
        return sizes + b"".join(np.packbits(bits).tobytes() for bits in self.levels)

    @classmethod
    def load(cls, data: bytes) -> "PerfectHash":
        n = int(np.frombuffer(data, "<i8", 1)[0])
        sizes, at, levels = np.frombuffer(data, "<i8", n, 8), 8 * (n + 1), []
        for size in map(int, sizes):
            width = (size + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, width, at), count=size).astype(bool))
            at += width
        return cls(levels)
