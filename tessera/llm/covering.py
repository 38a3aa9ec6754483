"""A covering code of the 64-bit space: two Golay blocks and two repetition blocks.

The anchors are the words of the product of four perfect codes: the binary Golay
code (23 bits, covering radius 3) twice and the 9-bit repetition code (radius 4)
twice.  2^26 anchors; every 64-bit word is within radius 14 of exactly one of
them, its home (radius by block 3, 3, 4, 4).

``anchors(words, t)`` gives each word's anchors within covering radius plus
``t``: those whose distance exceeds the blocks' radii by ``t`` bits in all at
most.  If x and y differ in ``t`` bits or fewer, the home of x is among the
anchors of y, so comparing each word with the homes at its anchors finds all
such pairs.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations, product

import numpy as np

#: Fixed value: a generator polynomial of the binary Golay code (23, 12).
GOLAY = 0b101011100011
BLOCKS = (23, 23, 9, 9)
_POPCOUNT = np.array([bin(x).count("1") for x in range(1 << 16)], np.uint8)


def popcount(x: np.ndarray) -> np.ndarray:
    """Bits set in each 64-bit word."""
    x = x.astype(np.uint64)
    return sum(_POPCOUNT[((x >> np.uint64(16 * k)) & np.uint64(0xFFFF)).astype(np.int64)].astype(np.int64) for k in range(4))


def _remainder(x: np.ndarray) -> np.ndarray:
    """The Golay syndrome (11 bits) of 23-bit words."""
    x = x.copy()
    for bit in range(22, 10, -1):
        x ^= np.where(x >> bit & 1, GOLAY << (bit - 11), 0)
    return x


@lru_cache(maxsize=4)
def _golay(t: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """By excess 0..t and syndrome: the patterns from a word to its anchors, -1 for none."""
    weights = range(0, 3 + t + 1)
    patterns = [np.array([sum(1 << b for b in bits) for bits in combinations(range(23), w)], np.int64) for w in weights]
    out = []
    for excess in range(t + 1):
        which = np.concatenate(patterns[:4] if excess == 0 else [patterns[3 + excess]])
        syndrome = _remainder(which)
        order = np.argsort(syndrome, kind="stable")
        which, syndrome = which[order], syndrome[order]
        starts = np.searchsorted(syndrome, np.arange(2049))
        n = np.diff(starts)
        table = np.full((2048, max(1, int(n.max()))), -1, np.int64)
        table[syndrome, np.arange(len(which)) - starts[syndrome]] = which
        out.append(table)
    return out


@lru_cache(maxsize=4)
def _repetition(t: int, bits: int = 9) -> list[np.ndarray]:
    """By excess and word: the patterns to its anchors (all zeros, all ones), -1 for none."""
    radius, full = bits // 2, (1 << bits) - 1
    out = [np.full((full + 1, 2), -1, np.int64) for _ in range(t + 1)]
    for x in range(full + 1):
        for k, pattern in enumerate((x, x ^ full)):
            excess = max(0, bin(pattern).count("1") - radius)
            if excess <= t:
                out[excess][x, k] = pattern
    return out


def anchors(words: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the word, anchor) of all anchors within covering radius plus ``t``."""
    words = words.astype(np.uint64)
    parts, shift = [], 0
    for bits in BLOCKS:
        parts.append(((words >> np.uint64(shift)) & np.uint64((1 << bits) - 1)).astype(np.int64))
        shift += bits
    tables = [_golay(t), _golay(t), _repetition(t), _repetition(t)]
    rows = [_remainder(p) if bits == 23 else p for p, bits in zip(parts, BLOCKS, strict=True)]
    index, found = [], []
    for excess in product(range(t + 1), repeat=4):
        if sum(excess) > t:
            continue
        at, anchor, shift = np.arange(len(words)), np.zeros(len(words), np.uint64), 0
        for part, row, table, e, bits in zip(parts, rows, tables, excess, BLOCKS, strict=True):
            pattern = table[e][row[at]]
            r, k = np.nonzero(pattern >= 0)
            at_new = at[r]
            anchor = anchor[r] | ((part[at_new] ^ pattern[r, k]).astype(np.uint64) << np.uint64(shift))
            at, shift = at_new, shift + bits
        index.append(at)
        found.append(anchor)
    return np.concatenate(index), np.concatenate(found)


def home(words: np.ndarray) -> np.ndarray:
    """The one anchor within the covering radius of each word."""
    index, found = anchors(words, 0)
    out = np.zeros(len(words), np.uint64)
    out[index] = found
    return out
