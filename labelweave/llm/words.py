"""Hashes of words and of runs of words, in numpy, for use inside tasks."""

from __future__ import annotations

import numpy as np

U = np.uint64
# Odd multipliers of polynomial hashes modulo 2**64, and the mixer's (fixed values).
BYTE_BASE = U(0x9E3779B97F4A7C15)
WORD_BASE = U(0xD6E8FEB86659FD93)
MIX_A, MIX_B = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
# Texts are hashed in pieces of about this many bytes, cut between words.
PIECE = 1 << 22

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over 64 bits, one to one."""
    x = (x ^ (x >> U(30))) * MIX_A
    x = (x ^ (x >> U(27))) * MIX_B
    return x ^ (x >> U(31))


def powers(base: U, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, U)
    out[0] = 1
    return np.multiply.accumulate(out)[:n]


class Hasher:
    """Keeps the tables of powers between calls."""

    def __init__(self) -> None:
        self._byte = powers(BYTE_BASE, 256)
        self._word = powers(WORD_BASE, 1024)
        self._back = powers(U(pow(int(WORD_BASE), -1, 1 << 64)), 1024)

    def words(self, data: bytes, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of every word of a text: runs of bytes but ASCII white space."""
        if lower:
            data = data.lower()
        if len(data) <= PIECE:
            return self._piece(data)
        out, start = [], 0
        while start < len(data):
            end = min(start + PIECE, len(data))
            while end < len(data) and not _SPACE[data[end]]:
                end += 1
            out.append(self._piece(data[start:end]))
            start = end
        return np.concatenate(out)

    def _piece(self, data: bytes) -> np.ndarray:
        raw = np.frombuffer(data, np.uint8)
        ink = ~_SPACE[raw]
        edges = np.flatnonzero(np.diff(ink, prepend=False, append=False))
        starts, lengths = edges[::2], edges[1::2] - edges[::2]
        if not len(starts):
            return np.zeros(0, U)
        if lengths.max() > len(self._byte):
            self._byte = powers(BYTE_BASE, int(lengths.max()))
        offsets = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) - np.repeat(offsets, lengths)
        terms = (raw[ink].astype(U) + U(1)) * self._byte[place]
        return mix(np.add.reduceat(terms, offsets) ^ (lengths.astype(U) * MIX_B))

    def windows(self, words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of every run of ``size`` words, by place of the first."""
        n = len(words)
        if n < size:
            return np.zeros(0, U)
        if n + 1 > len(self._word):
            self._word = powers(WORD_BASE, 2 * n + 2)
            self._back = powers(U(pow(int(WORD_BASE), -1, 1 << 64)), 2 * n + 2)
        sums = np.zeros(n + 1, U)
        np.cumsum(words * self._word[:n], out=sums[1:])
        spread = (sums[size:] - sums[:-size]) * self._back[: n - size + 1]
        return mix(spread + U((size * int(MIX_A) + seed * int(MIX_B)) % (1 << 64)))


def covered(n: int, starts: np.ndarray, size: int) -> np.ndarray:
    """Which of ``n`` words lie in a run of ``size`` that starts at one of ``starts``."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + size, -1)
    return np.cumsum(change[:n]) > 0
