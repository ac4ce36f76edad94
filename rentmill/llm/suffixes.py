"""Suffix arrays in numpy: refinement of sorted groups by doubling, and common prefixes of neighbours."""

from __future__ import annotations

import numpy as np

LANES = 2048


def suffix_order(text: np.ndarray) -> np.ndarray:
    """The suffix array: where the suffixes begin, in their order.

    Suffixes start out sorted by eight bytes. A group of equal suffixes has the rank of its last member; each round sorts
    the members of every group that is not single by the rank ``width`` bytes further on and splits it, which
    doubles the width. Groups that are single are never looked at again.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    keys = np.zeros(n, np.uint64)
    for k in range(8):
        keys = (keys << np.uint64(8)) | padded[k : n + k]
    order = np.argsort(keys, kind="stable")
    fresh = np.r_[True, keys[order[1:]] != keys[order[:-1]]]
    rank = np.zeros(n, np.int64)
    width = 8
    place = np.arange(n)
    while True:
        last = np.r_[np.flatnonzero(fresh)[1:] - 1, n - 1]
        number = np.cumsum(fresh) - 1
        rank[order] = last[number]
        single = np.r_[fresh[1:], True] & fresh
        left = place[~single]
        if not len(left):
            return order
        members = order[left]
        ahead = members + width
        further = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = rank[members] * (n + 1) + further
        by_key = np.argsort(key, kind="stable")
        order[left] = members[by_key]
        key = key[by_key]
        fresh[left] = np.r_[True, key[1:] != key[:-1]]
        width *= 2


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """The length of the common prefix of each suffix and the one before it in order, counted up to ``most``.

    The next suffix of the text shares at most one byte less with its own neighbour, so a count goes on from the last one
    (Kasai). Stretches of the text are walked side by side, one numpy lane each.
    """
    n = len(order)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int64)
    padded = np.concatenate([text.astype(np.int16), np.full(most + 1, -1, np.int16)])
    stretch = -(-n // LANES)
    at = np.arange(0, n, stretch)
    count = np.zeros(len(at), np.int64)
    for step in range(stretch):
        here = at + step
        here = here[here < np.minimum(at + stretch, n)] if step else here
        count = count[: len(here)]
        other = before[here]
        count[other < 0] = 0
        going = np.flatnonzero((other >= 0) & (count < most))
        while len(going):
            same = padded[here[going] + count[going]] == padded[other[going] + count[going]]
            same &= padded[here[going] + count[going]] >= 0
            count[going[same]] += 1
            going = going[same]
            going = going[count[going] < most]
        shared[here] = count
        count = np.maximum(count - 1, 0)
    result = np.zeros(n, np.int64)
    result[1:] = shared[order[1:]]
    return result
