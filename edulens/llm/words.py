"""Words of a text and 64-bit hashes of words and of windows of words, in numpy.

A word is a run of bytes that are not ASCII white space (0x20, 0x09-0x0D).
The hash of a word adds, for each byte, a random number of the byte times an
odd random number of its place; windows add their words' hashes times one odd
number per place. Two different windows collide with a chance of about 2**-64.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64)."""
    x = x + U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _place_keys(n: int) -> np.ndarray:
    return mixed(np.arange(n, dtype=U) + U(1 << 40)) | U(1)


_BYTE = mixed(np.arange(256, dtype=U) + U(1 << 50))
_PLACE = _place_keys(256)
_STEP = mixed(np.arange(64, dtype=U) + U(1 << 60)) | U(1)


def word_spans(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of each word."""
    flags = np.ones(len(text) + 2, bool)
    flags[1:-1] = _SPACE[np.frombuffer(text, np.uint8)]
    edges = np.flatnonzero(flags[1:] != flags[:-1])
    return edges[::2], edges[1::2]


def word_hashes(text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.empty(0, U)
    buf = np.frombuffer(text, np.uint8)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    keep = buf[~_SPACE[buf]]
    place = np.arange(len(keep)) - np.repeat(first, lengths)
    keys = _PLACE if (longest := int(lengths.max())) <= len(_PLACE) else _place_keys(longest)
    return mixed(np.add.reduceat(_BYTE[keep] * keys[place], first) + lengths.astype(U))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of ``size`` words, in order of the text."""
    n = len(words) - size + 1
    if n < 1:
        return np.empty(0, U)
    steps = _STEP if size <= len(_STEP) else mixed(np.arange(size, dtype=U) + U(1 << 60)) | U(1)
    total = np.full(n, size, U)
    for j in range(size):
        total += words[j : n + j] * steps[j]
    return mixed(total)


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Sorted hashes of the distinct ``size``-word shingles of a text whose
    A-Z are lowered; a text with fewer words is one shingle, without words none."""
    text = text.lower()
    starts, ends = word_spans(text)
    words = word_hashes(text, starts, ends)
    if not len(words):
        return words
    return np.unique(window_hashes(words, min(size, len(words))))
