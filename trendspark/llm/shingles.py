"""Word shingles of texts as 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np

#: The bytes that separate words (space and the ASCII controls 9 to 13).
SEPARATORS = [0x20, *range(0x09, 0x0E)]
_SEPARATES = np.zeros(256, bool)
_SEPARATES[SEPARATORS] = True
_rng = np.random.default_rng(20240607)
_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PLACES = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (in a new array)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(data: bytes, lower: bool = False) -> np.ndarray:
    """One hash for each word of a UTF-8 text, in order. ``lower`` folds A-Z."""
    if not data:
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(data, np.uint8)
    inside = ~_SEPARATES[raw]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    if lower:
        raw = _LOWER[raw]
    lengths = ends - starts
    raw, inside, starts = raw[starts[0]:], inside[starts[0]:], starts - starts[0]
    at = np.arange(len(raw)) - np.repeat(starts, np.diff(starts, append=len(raw)))
    # a word's hash: the sum of mixed (byte, place) values; each 256 places another odd factor comes in
    value = _VALUES[raw] * _PLACES[at & 255]
    if int(lengths.max()) > 256:
        value *= ((at >> 8).astype(np.uint64) * _STEP) | np.uint64(1)
    value ^= value >> np.uint64(32)
    value *= _STEP
    value[~inside] = 0
    return mix(np.add.reduceat(value, starts) + lengths.astype(np.uint64))


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; fewer words are one shingle, no words give none."""
    if not len(words):
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    out = words[:n].copy()
    for i in range(1, width):
        out = mix(out + _STEP) + words[i:i + n]
    return mix(out + np.uint64(width))
