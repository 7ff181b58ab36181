"""64-bit hashes of byte strings in numpy: rolling ones for windows of bounded length, mixed ones for words."""

from __future__ import annotations

import hashlib

import numpy as np

BASE = 0x9E3779B97F4A7C15
U = np.uint64


def scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(29))) * U(0xBF58476D1CE4E5B9)
    return h ^ (h >> U(32))


LONG_WORD = 64  # bytes: longer words are hashed by blake2b


def mixed(t: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hashes of the bytes [lo, hi): eight bytes at a time through multiplications and shifts, no polynomial of the bytes.

    A polynomial modulo 2^64 takes structured strings (Thue-Morse) for equal whatever its base; here
    every step mixes all bits of the state, and words over ``LONG_WORD`` bytes get a cryptographic digest.
    """
    sizes = hi - lo
    padded = np.concatenate([t, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(t) + 1, "<u8", padded.data, strides=(1,))  # the eight bytes from each place on
    h = scramble(sizes.astype(U) * U(BASE) + U(0x2545F4914F6CDD1D))
    short = np.flatnonzero(sizes <= LONG_WORD)
    at = short[np.argsort(-sizes[short], kind="stable")]
    n, start, state = sizes[at], lo[at], h[at]
    for c in range(0, LONG_WORD, 8):
        k = int(np.searchsorted(-n, -c, "left"))  # words with more than c bytes
        if not k:
            break
        rest = np.minimum(n[:k] - c, 8).astype(U)
        v = eight[start[:k] + c] & (U(0xFFFFFFFFFFFFFFFF) >> (U(64) - rest * U(8)))
        x = (state[:k] ^ v) * U(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
        state[:k] = x ^ (x >> U(32))
    h[at] = state
    for k in np.flatnonzero(sizes > LONG_WORD).tolist():
        h[k] = int.from_bytes(hashlib.blake2b(t[lo[k]:hi[k]].tobytes(), digest_size=8).digest(), "little")
    return h


class Hashes:
    """Prefix sums of byte * BASE**position; a substring's share moved to position 0 is its hash.

    Different strings of structure meet from 2,048 bytes on (Thue-Morse), so this is for windows far below that.
    """

    def __init__(self, size: int):
        self.power = self.inverse = np.zeros(0, U)
        self.grow(size)

    def grow(self, size: int) -> None:
        if size > len(self.power):
            self.power, self.inverse = np.full(size, U(BASE)), np.full(size, U(pow(BASE, -1, 1 << 64)))
            self.power[0] = self.inverse[0] = U(1)
            np.multiply.accumulate(self.power, out=self.power)
            np.multiply.accumulate(self.inverse, out=self.inverse)

    def prefix(self, t: np.ndarray) -> np.ndarray:
        self.grow(len(t) + 1)
        c = np.zeros(len(t) + 1, U)
        np.cumsum((t.astype(U) + U(1)) * self.power[:len(t)], out=c[1:])
        return c

    def of(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Hashes of the bytes [lo, hi)."""
        return scramble((c[hi] - c[lo]) * self.inverse[lo])
