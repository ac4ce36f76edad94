"""The cutting-stock linear program by column generation: a histogram of lengths into patterns of one capacity.

Sizes are whole units. The work depends on the number of distinct sizes, at most the capacity in units, and not on how
many items there are, so it is the same small job on the driver for any input.
"""

from __future__ import annotations

import numpy as np

MOST_ROUNDS = 1500
GAP = 5e-4


def best_pattern(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The knapsack problem with repeated items, by dynamic programming over the capacity."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        fits = sizes <= room
        if fits.any():
            gains = np.where(fits, best[room - np.minimum(sizes, room)] + values, -np.inf)
            k = int(np.argmax(gains))
            if gains[k] > best[room] + 1e-12:
                best[room], choice[room] = gains[k], k
    counts, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            counts[choice[room]] += 1
            room -= sizes[choice[room]]
    return float(best[capacity]), counts


def solve_patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (a column each) and how often each is used, from the linear program; usage is fractional.

    The basis starts with one pattern per size. Each round prices a new pattern by the knapsack, brings it in by the ratio
    test, and ends when no pattern helps or the dual bound shows that under a share ``GAP`` is left to gain.
    """
    basis = np.diag(capacity // sizes).astype(float)
    need = demand.astype(float)
    usage = np.linalg.solve(basis, need)
    for _ in range(MOST_ROUNDS):
        prices = np.linalg.solve(basis.T, np.ones(len(sizes)))
        value, column = best_pattern(prices, sizes, capacity)
        if value <= 1 + 1e-9 or usage.sum() - prices @ need / value <= max(0.5, GAP * usage.sum()):
            break
        step = np.linalg.solve(basis, column)
        ratio = np.where(step > 1e-9, usage / np.maximum(step, 1e-9), np.inf)
        basis[:, int(np.argmin(ratio))] = column
        usage = np.maximum(np.linalg.solve(basis, need), 0)
    return np.rint(basis).astype(np.int64), usage


def whole_patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns with whole usage that take every item exactly once.

    Usage is rounded down; what is left, less than one pattern per size, is filled in largest first.
    """
    if not len(sizes):
        return []
    basis, usage = solve_patterns(sizes, demand, capacity)
    times = np.floor(usage + 1e-9).astype(np.int64)
    while np.any(left := demand - basis @ times < 0):  # a rounding error of the solver took an item too many
        times[np.argmax((basis[np.argmax(left)] > 0) & (times > 0))] -= 1
    left = demand - basis @ times
    made = [(basis[:, k], int(times[k])) for k in range(len(times)) if times[k] > 0]
    order = np.argsort(-sizes, kind="stable")
    while left.any():
        pattern, room = np.zeros(len(sizes), np.int64), capacity
        for k in order:
            take = min(left[k], room // sizes[k])
            pattern[k], room = take, room - take * sizes[k]
        repeat = int(min(left[k] // pattern[k] for k in order if pattern[k]))
        left = left - pattern * repeat
        made.append((pattern, repeat))
    return made
