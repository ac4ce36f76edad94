"""Sets of hashed word shingles, made from the bytes of a block of texts at once.

Words are maximal runs without white space, with A-Z in lower case. A set holds a 64-bit hash of every run of
``WORDS`` words; a text with fewer words has one shingle, all its words; a text without words has none.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

WORDS = 5
STRETCH_BITS = 21
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE, _INVERSE = 0x5851F42D4C957F2D, pow(0x5851F42D4C957F2D, -1, 1 << 64)
_STEPS = [np.uint64(pow(0xD6E8FEB86659FD93, k + 1, 1 << 64)) for k in range(WORDS)]

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)


@lru_cache(maxsize=4)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    made = []
    for base in (_BASE, _INVERSE):
        steps = np.full(1 << bits, base, np.uint64)
        steps[0] = 1
        made.append(np.cumprod(steps, dtype=np.uint64))
    return made[0], made[1]


def _words(flat: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of a stretch begin and end, and of each the sum that its hash is made from; a text begins at each of ``edges``."""
    inside = ~SPACES[flat]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    before = edges[edges > 0] - 1
    ends[before] = inside[before]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _powers(16 if len(flat) < 1 << 16 else STRETCH_BITS)
    sums = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum(VALUES[LOWER[flat]] * up[: len(flat)], out=sums[1:])
    return first, last, (sums[last] - sums[first]) * down[first]


def word_hashes(flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash per word of all texts, and the number of the first word of each text (one more entry than texts).

    Bytes are read a stretch at a time, so a very long text takes memory for its words and not for all its bytes at once.
    """
    edges = starts[:-1][starts[:-1] < starts[1:]]
    firsts, lengths, sums = ([np.zeros(0, kind)] for kind in (np.int64, np.int64, np.uint64))
    for at in range(0, len(flat), 1 << STRETCH_BITS):
        own = edges[np.searchsorted(edges, at) : np.searchsorted(edges, at + (1 << STRETCH_BITS))] - at
        first, last, total = _words(flat[at : at + (1 << STRETCH_BITS)], own)
        length = last - first
        goes_on = at and not SPACES[flat[at - 1]] and len(first) and first[0] == 0 and not (len(own) and own[0] == 0)
        if goes_on:  # the word that the stretch before ended in
            power = np.array([pow(_BASE, int(lengths[-1][-1]), 1 << 64)], np.uint64)
            sums[-1][-1:] += total[:1] * power
            lengths[-1][-1] += length[0]
            first, length, total = first[1:], length[1:], total[1:]
        if len(first):
            firsts.append(first + at)
            lengths.append(length)
            sums.append(total)
    first, length, total = (np.concatenate(x) for x in (firsts, lengths, sums))
    return mixed(total + length.astype(np.uint64) * _ODD), np.searchsorted(first, starts)


def shingle_sets(flat: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    words, bounds = word_hashes(flat, starts)
    whole = np.zeros(len(words), np.uint64)
    full = len(words) - WORDS + 1
    if full > 0:
        total = np.zeros(full, np.uint64)
        for k, step in enumerate(_STEPS):
            total += words[k : k + full] * step
        whole[:full] = mixed(total)
    sets = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= WORDS:
            sets.append(np.unique(whole[a : b - WORDS + 1]))
        elif b > a:
            short = sum((words[a + k : a + k + 1] * _STEPS[k] for k in range(b - a)), np.array([b - a], np.uint64) * _ODD)
            sets.append(mixed(short))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def set_id(hashes: np.ndarray) -> int:
    """A 64-bit name of a set: equal for equal sets."""
    total = mixed(hashes ^ _ODD).sum(dtype=np.uint64, keepdims=True) + np.array([len(hashes)], np.uint64) * _ODD
    return int(mixed(total).view(np.int64)[0])
