"""Recompression: a run-length grammar of a sequence, and extensions read from it.

Blocks of equal symbols and then pairs of neighbours are replaced by new symbols, in
turns, until one symbol is left. What is replaced depends on the symbols alone, so equal
stretches are compressed alike but at their edges. How far two places agree is found by
climbing while they agree and descending into what first differs: a few steps a level.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

# Odd multiplier that deals symbols to the two sides of pairs (fixed value).
SIDES = 0x9E3779B97F4A7C15


class Level(NamedTuple):
    """Symbols, and how they are grouped to those of the next level."""

    symbols: np.ndarray
    start: np.ndarray  # first child of each symbol of the next level
    end: np.ndarray  # one past its last child
    parent: np.ndarray
    pairs: bool


def _named(keys: np.ndarray, first: int) -> tuple[np.ndarray, int]:
    """Names from ``first`` on, equal for equal keys, and the next free name."""
    values, names = np.unique(keys, return_inverse=True)
    return names + first, first + len(values)


def _level(symbols: np.ndarray, start: np.ndarray, pairs: bool) -> Level:
    end = np.append(start[1:], len(symbols))
    parent = np.repeat(np.arange(len(start)), end - start)
    return Level(symbols, start, end, parent, pairs)


def _sides(symbols: np.ndarray, seed: int) -> np.ndarray:
    factor = (SIDES * (2 * seed + 1)) % (1 << 64)
    return (symbols.astype(np.uint64) * np.uint64(factor)) >> np.uint64(63) == 1


def grammar(symbols: np.ndarray) -> list[Level]:
    """Levels from the sequence itself up to the one below its last symbol.

    ``symbols`` are whole numbers from 0 on, below 2**31 with all names that are added.
    """
    symbols = symbols.astype(np.int64)
    free = int(symbols.max(initial=0)) + 1
    levels: list[Level] = []
    seed = 0
    while len(symbols) > 1:
        start = np.flatnonzero(np.diff(symbols, prepend=-1))
        if len(start) < len(symbols):
            levels.append(_level(symbols, start, False))
            size = np.diff(np.append(start, len(symbols)))
            blocks, symbols = np.flatnonzero(size > 1), symbols[start]
            keys = symbols[blocks] * (int(size.max()) + 1) + size[blocks]
            symbols[blocks], free = _named(keys, free)
        side = _sides(symbols, seed)
        seed += 1
        upward, downward = ~side[:-1] & side[1:], side[:-1] & ~side[1:]
        met = upward if upward.sum() >= downward.sum() else downward
        if met.any():
            start = np.flatnonzero(np.append(True, ~met))
            levels.append(_level(symbols, start, True))
            pairs = np.flatnonzero(np.append(met, False)[start])
            left = start[pairs]
            keys = symbols[left] * free + symbols[left + 1]
            symbols = symbols[start]
            symbols[pairs], free = _named(keys, free)
    return levels


def mirrored(levels: list[Level]) -> list[Level]:
    """The grammar of the reversed sequence."""
    out = []
    for level in levels:
        n, above = len(level.symbols), len(level.start)
        out.append(
            Level(
                level.symbols[::-1],
                n - level.end[::-1],
                n - level.start[::-1],
                above - 1 - level.parent[::-1],
                level.pairs,
            )
        )
    return out


def extensions(levels: list[Level], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many symbols from each of ``x`` on equal those from its ``y`` on.

    Places differ within each couple, and the sequence ends in a symbol that it holds
    nowhere else, so that no couple agrees to the end.
    """
    at_x, at_y = x.copy(), y.copy()
    going = np.arange(len(x))
    met: list[np.ndarray] = []  # by level, the couples whose symbols differ there
    for level in levels:
        if not len(going):
            break
        a, b = at_x[going], at_y[going]
        up_a, up_b = level.parent[a], level.parent[b]
        same = level.symbols[a] == level.symbols[b]
        first = (level.start[up_a] == a) & (level.start[up_b] == b)
        left_a, left_b = level.end[up_a] - a, level.end[up_b] - b
        # Inside a group, both go to its end; groups that end apart differ there.
        step = np.where(same & ~first, np.minimum(left_a, left_b), 0)
        climbs = same & (first | (left_a == left_b))
        at_x[going], at_y[going] = a + step, b + step
        met.append(going[~climbs])
        going, first = going[climbs], first[climbs]
        at_x[going] = up_a[climbs] + ~first
        at_y[going] = up_b[climbs] + ~first
    if len(going):
        raise ValueError("places must differ, and the last symbol must be its only one")
    falling = np.zeros(0, np.int64)
    for depth in range(len(met) - 1, 0, -1):
        below = levels[depth - 1]
        falling = np.concatenate([falling, met[depth]])
        a, b = at_x[falling], at_y[falling]
        child_a, child_b = below.start[a], below.start[b]
        size = 1 if below.pairs else np.minimum(below.end[a] - child_a, below.end[b] - child_b)
        step = np.where(below.symbols[child_a] == below.symbols[child_b], size, 0)
        at_x[falling], at_y[falling] = child_a + step, child_b + step
    return at_x - x
