"""Words of many texts at once, in NumPy: positions and 64-bit hashes over the bytes of an Arrow column."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: A random number for each byte value and an odd base with its inverse: hashes are polynomials modulo 2 ** 64.
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MULTIPLY = np.uint64(0xFF51AFD7ED558CCD)


def _powers(base: int, n: int, known: dict[int, np.ndarray] = {}) -> np.ndarray:  # noqa: B006
    got = known.get(base)
    if got is None or len(got) < n:
        got = np.full(max(n, 1 << 16), base, np.uint64)
        got[0] = 1
        known[base] = got = np.multiply.accumulate(got)
    return got[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MULTIPLY
    return h ^ (h >> np.uint64(29))


class Rolling:
    """Hashes of byte ranges of one buffer. Equal ranges have equal hashes; others differ but for a chance near 2 ** -64."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * _powers(_BASE, len(data)), out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        back = _powers(_INVERSE, len(self.sums))[starts]
        return mix((self.sums[ends] - self.sums[starts]) * back + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray  # row of each word
    first: np.ndarray  # index of each row's first word, and at the end the number of words


def find_words(data: np.ndarray, at: np.ndarray) -> Words:
    """Runs of bytes that aren't white space, cut at row boundaries. at: row offsets into data, from 0."""
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    starts = np.flatnonzero(solid[1:] & (~solid[:-1] | edge))
    ends = np.flatnonzero(solid[:-1] & (~solid[1:] | edge))
    first = np.searchsorted(starts, at)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(first))
    return Words(starts, ends, doc, first)


def grams(hashes: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words of one row, and the index of each one's first word."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = h * np.uint64(_BASE) + hashes[i : i + n]
    own = np.flatnonzero(doc[:n] == doc[k - 1 :])
    return mix(h[own]), own
