"""Boolean trigram queries for regular expressions, and postings of a block of texts.

A text can only match a regular expression if it holds certain trigrams. The query is built from the parsed
expression: literal runs, with their alternatives multiplied out while they are few, must appear, and a run
of three or more bytes appears only if each of its trigrams does. Trigrams are over ASCII-lowercased UTF-8 bytes, which
serves expressions of either case.
"""

from __future__ import annotations

from re import _constants as sre
from re import _parser as sre_parser

import numpy as np

# A query is None (no text is ruled out), a trigram, or ("and" | "or", list of queries).
MOST_STRINGS = 64
FEW_CHARACTERS = 6


def trigram_query(pattern: str, flags: int = 0):
    return _of_sequence(sre_parser.parse(pattern, flags))


def _and(parts):
    parts = [p for p in parts if p is not None]
    return None if not parts else parts[0] if len(parts) == 1 else ("and", parts)


def _or(parts):
    return None if any(p is None for p in parts) else parts[0] if len(parts) == 1 else ("or", parts)


def _of_string(text: str):
    data = text.encode("utf-8", "surrogatepass").lower()
    return _and(sorted({data[i : i + 3] for i in range(len(data) - 2)}))


def _strings(op, arg) -> set[str] | None:
    """Every string an element can match, if they are few."""
    if op is sre.LITERAL:
        return {chr(arg)}
    if op is sre.AT:
        return {""}
    if op is sre.IN:
        found: set[str] = set()
        for kind, value in arg:
            if kind is sre.LITERAL:
                found.add(chr(value))
            elif kind is sre.RANGE and value[1] - value[0] < FEW_CHARACTERS:
                found |= {chr(c) for c in range(value[0], value[1] + 1)}
            else:
                return None
        return found if len(found) <= FEW_CHARACTERS else None
    if op is sre.SUBPATTERN:
        return _strings_of_sequence(arg[3])
    if op is sre.BRANCH:
        options = [_strings_of_sequence(option) for option in arg[1]]
        return None if any(o is None for o in options) else set().union(*options)
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        least, most, inner = arg
        once = _strings_of_sequence(inner)
        if once is None or most > 2:
            return None
        return set().union(*({""} if k == 0 else once if k == 1 else {a + b for a in once for b in once} for k in range(least, most + 1)))
    return None


def _strings_of_sequence(sequence) -> set[str] | None:
    strings = {""}
    for op, arg in sequence:
        tail = _strings(op, arg)
        if tail is None or len(strings) * len(tail) > MOST_STRINGS:
            return None
        strings = {a + b for a in strings for b in tail}
    return strings


def _of_sequence(sequence):
    needed, strings = [], {""}
    for op, arg in sequence:
        tail = _strings(op, arg)
        if tail is not None and len(strings) * len(tail) <= MOST_STRINGS:
            strings = {a + b for a in strings for b in tail}
            continue
        needed.append(_or([_of_string(s) for s in strings]))
        strings = tail if tail is not None else {""}
        if tail is None:
            needed.append(_of_element(op, arg))
    return _and([*needed, _or([_of_string(s) for s in strings])])


def _of_element(op, arg):
    if op is sre.SUBPATTERN:
        return _of_sequence(arg[3])
    if op is sre.BRANCH:
        return _or([_of_sequence(option) for option in arg[1]])
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] >= 1:
        return _of_sequence(arg[2])
    return None


def trigrams_of(query) -> set[bytes]:
    if query is None:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*(trigrams_of(part) for part in query[1]))


class PostingIndex:
    """Inverted lists of chosen trigrams over one block of texts at a time."""

    def __init__(self, trigrams: set[bytes]):
        self.slots = {trigram: k + 1 for k, trigram in enumerate(sorted(trigrams))}
        self.table = np.zeros(1 << 24, np.uint16)
        for trigram, slot in self.slots.items():
            self.table[int.from_bytes(trigram, "big")] = slot
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[ord("A") : ord("Z") + 1] += 32

    def fill(self, flat: np.ndarray, starts: np.ndarray) -> None:
        """Post every text of a block. Trigrams across two texts are posted too; they only add candidates."""
        self.postings = np.zeros((len(self.slots) + 1, len(starts) - 1), bool)
        if len(flat) < 3:
            return
        low = self.lower[flat].astype(np.uint32)
        slots = self.table[(low[:-2] << 16) | (low[1:-1] << 8) | low[2:]]
        places = np.flatnonzero(slots)
        self.postings[slots[places], np.searchsorted(starts, places, side="right") - 1] = True

    def candidates(self, query) -> np.ndarray:
        """One flag per text: whether the query leaves it as a candidate."""
        if query is None:
            return np.ones(self.postings.shape[1], bool)
        if isinstance(query, bytes):
            return self.postings[self.slots[query]]
        merge = np.logical_and if query[0] == "and" else np.logical_or
        return merge.reduce([self.candidates(part) for part in query[1]])
