"""Words of many texts at once, as 64-bit hashes, without a Python loop over them."""

from __future__ import annotations

import numpy as np

#: Odd, so that its powers have inverses modulo 2**64.
BASE = np.uint64(0x9E3779B97F4A7C15)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE ** i`` and its inverse for ``i`` below ``n``, modulo 2**64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((int(BASE), pow(int(BASE), -1, 1 << 64))):
            steps = np.full(n, np.uint64(base))
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def byte_codes(lower: bool = True) -> np.ndarray:
    """A 64-bit number for each byte; with ``lower``, A-Z have those of a-z."""
    codes = mix(np.arange(1, 257, dtype=np.uint64) * BASE)
    if lower:
        codes[65:91] = codes[97:123]
    return codes


def without(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of the bytes that belong to words: all but those of the ranges, ends included."""
    inside = np.ones(256, bool)
    for a, b in ranges:
        inside[a:b + 1] = False
    return inside


#: Runs of anything but white space.
SPACED = without((9, 13), (32, 32))
#: Runs of letters, digits and bytes beyond ASCII.
ALNUM = without((0, 47), (58, 64), (91, 96), (123, 127))


def spans(data: np.ndarray, places: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every word. Words don't cross rows."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    own = inside[data]
    before = np.empty_like(own)
    before[0], before[1:] = False, own[:-1]
    after = np.empty_like(own)
    after[-1], after[:-1] = False, own[1:]
    cuts = places[:-1][places[:-1] < len(data)]
    before[cuts] = False
    after[cuts[cuts > 0] - 1] = False
    return np.flatnonzero(own & ~before), np.flatnonzero(own & ~after) + 1


def hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each word, the same wherever the word stands."""
    if not len(begins):
        return np.zeros(0, np.uint64)
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(codes[data] * up[:-1], out=total[1:])
    return mix((total[ends] - total[begins]) * down[begins] + (ends - begins).astype(np.uint64))


def rows_of(begins: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The row that each word belongs to."""
    return np.searchsorted(places, begins, "right") - 1
