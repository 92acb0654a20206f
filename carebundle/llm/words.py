"""Hashes of the words of many texts at once, straight from their UTF-8 bytes.

A word is a maximal run of bytes other than white space, with A-Z in lower case.  Its hash is a polynomial over its
bytes modulo 2^64, taken as a difference of prefix sums, and then mixed.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SALT = 0xD6E8FEB86659FD93


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    z = values + np.uint64((seed * _SALT + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse for positions below 2^bits."""
    both = []
    for factor in (_BASE, _INVERSE):
        values = np.full(1 << bits, factor, np.uint64)
        values[0] = 1
        both.append(np.cumprod(values, dtype=np.uint64))
    return both[0], both[1]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each text the index of its first word (one entry more than texts)."""
    base = int(offsets[0])
    data = data[base : int(offsets[-1])]
    offsets = offsets - base
    if len(data) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    lower = data | (((data - np.uint8(65)) < 26).astype(np.uint8) << np.uint8(5))
    space = (data == 32) | ((data - np.uint8(9)) < 5)
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    starts = ~space
    starts[1:] &= space[:-1]
    starts[inner] = ~space[inner]
    ends = ~space
    ends[:-1] &= space[1:]
    ends[inner - 1] = ~space[inner - 1]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    powers, inverses = _powers(max(20, int(len(data)).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((lower.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    hashes = (sums[last] - sums[first]) * inverses[first]
    hashes = mixed(hashes ^ ((last - first).astype(np.uint64) << np.uint64(48)))
    return hashes, np.searchsorted(first, offsets)


def shingle_sets(hashes: np.ndarray, firsts: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted distinct hashes of the runs of ``width`` words of each text; a text with fewer words has its whole
    sequence as its one shingle, and none without words."""
    count = max(len(hashes) - width + 1, 0)
    runs = np.zeros(count, np.uint64)
    for step in range(width):
        runs = runs * np.uint64(_BASE) + hashes[step : step + count]
    runs = mixed(runs, width)
    found = []
    for low, high in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
        if high - low >= width:
            values = np.sort(runs[low : high - width + 1])
            keep = np.empty(len(values), bool)
            keep[0] = True
            np.not_equal(values[1:], values[:-1], out=keep[1:])
            found.append(values[keep])
        elif high > low:
            value = np.zeros(1, np.uint64)
            for word in hashes[low:high]:
                value = value * np.uint64(_BASE) + word
            found.append(mixed(value, high - low))
        else:
            found.append(np.zeros(0, np.uint64))
    return found
