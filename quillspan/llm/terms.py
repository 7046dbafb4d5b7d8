"""Terms of many texts at once: maximal runs of ASCII letters, digits and characters beyond ASCII, only A-Z lower-cased."""

from __future__ import annotations

import numpy as np

from quillspan.llm.words import LOWER, Rolling, Words

#: A term in Java's, Python's and RE2's regular expressions.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of terms: every byte of a character beyond ASCII is one, so runs of bytes are runs of characters.
_OF_TERM = np.zeros(256, bool)
_OF_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def find_terms(data: np.ndarray, at: np.ndarray) -> Words:
    """Runs of term bytes, cut at row boundaries. at: row offsets into data, from 0."""
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = _OF_TERM[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    starts = np.flatnonzero(solid[1:] & (~solid[:-1] | edge))
    ends = np.flatnonzero(solid[:-1] & (~solid[1:] | edge))
    first = np.searchsorted(starts, at)
    return Words(starts, ends, np.repeat(np.arange(len(at) - 1), np.diff(first)), first)


def hashed(data: np.ndarray, at: np.ndarray) -> tuple[Words, np.ndarray]:
    """Terms and a 64-bit hash of each, as it is lower-cased."""
    w = find_terms(data, at)
    return w, Rolling(LOWER[data])(w.starts, w.ends)


def counted(doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (doc, hash) with how often each occurs, by doc, then hash."""
    if not len(doc):
        return doc, hashes, np.zeros(0, np.int64)
    sort = np.lexsort((hashes, doc))
    d, h = doc[sort], hashes[sort]
    head = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (h[1:] != h[:-1])])
    return d[head], h[head], np.diff(np.r_[head, len(d)])
