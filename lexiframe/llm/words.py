"""Words of many texts at once: NumPy over the UTF-8 bytes of a column, without Python strings."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SPACES = np.zeros(256, bool)
_SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes that are hashed in one step, to bound the 8 bytes of workspace for each.
STEP = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on all bits of x."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def split(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the number of words before each text.

    Words are runs of bytes other than blanks; a word never crosses from one text to the next.
    """
    letter = ~_SPACES[data]
    breaks = np.zeros(len(data) + 1, bool)
    breaks[offsets] = True
    before = np.concatenate(([False], letter[:-1])) if len(data) else letter
    after = np.concatenate((letter[1:], [False])) if len(data) else letter
    starts = np.flatnonzero(letter & (~before | breaks[:-1]))
    ends = np.flatnonzero(letter & (~after | breaks[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same wherever the word stands."""
    table = mix(np.arange(1, 257, dtype=np.uint64))
    inverse = pow(_BASE, -1, 1 << 64)
    out = np.empty(len(starts), np.uint64)
    up = down = np.empty(0, np.uint64)
    first = 0
    while first < len(starts):
        low = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, low + STEP, "right")))
        high = ends[last - 1]
        if len(up) <= high - low:
            up, down = _powers(high - low + 1, _BASE), _powers(high - low + 1, inverse)
        total = np.zeros(high - low + 1, np.uint64)
        np.cumsum(table[data[low:high]] * up[: high - low], out=total[1:])
        s, e = starts[first:last] - low, ends[first:last] - low
        out[first:last] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        first = last
    return out


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n words that begin at each word; the last n-1 places have none."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    factors = mix(np.arange(11, 11 + n, dtype=np.uint64)) | np.uint64(1)
    total = np.zeros(count, np.uint64)
    for i in range(n):
        total += words[i : i + count] * factors[i]
    return mix(total)


def least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of `width` values that begin at each place, the leftmost of equals."""
    value, place, have = values, np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        left, right = value[:-step], value[step:]
        later = right < left
        place = np.where(later, place[step:], place[:-step])
        value = np.where(later, right, left)
        have += step
    return place


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All words with one space after each, and where each begins there."""
    lengths = ends - starts
    places = np.concatenate(([0], np.cumsum(lengths + 1)))
    out = np.full(places[-1], 32, np.uint8)
    inside = np.ones(places[-1], bool)
    inside[places[1:] - 1] = False
    letters = np.zeros(len(data) + 1, np.int8)
    letters[starts] += 1
    np.subtract.at(letters, ends, 1)
    out[inside] = data[np.cumsum(letters[:-1], dtype=np.int8).astype(bool)]
    return out.tobytes(), places
