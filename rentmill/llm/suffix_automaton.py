"""A generalised suffix automaton over sequences of tokens, and matching statistics of a stream against it."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence


class SuffixAutomaton:
    """All substrings of several token sequences in one automaton, linear in their total length.

    ``step`` holds a state's transitions, ``link`` the state of its longest suffix that occurs elsewhere too, and ``longest``
    the length of its longest string. ``places`` of a state are the (sequence, end) where its strings end.
    """

    def __init__(self, sequences: Iterable[Sequence[int]]) -> None:
        self.step: list[dict[int, int]] = [{}]
        self.link, self.longest = [-1], [0]
        self.places: list[set[tuple[int, int]]] = [set()]
        for number, sequence in enumerate(sequences):
            last = 0
            for at, token in enumerate(sequence):
                last = self._extended(last, token)
                self.places[last].add((number, at + 1))
        for state in sorted(range(1, len(self.link)), key=self.longest.__getitem__, reverse=True):
            if self.link[state]:
                self.places[self.link[state]] |= self.places[state]

    def _extended(self, last: int, token: int) -> int:
        """The state of the sequence so far, that of ``last``, followed by ``token``."""
        if token in self.step[last]:  # another sequence went on like this
            onward = self.step[last][token]
            return onward if self.longest[onward] == self.longest[last] + 1 else self._split(last, token, onward)
        state = self._new({}, self.longest[last] + 1)
        while last >= 0 and token not in self.step[last]:
            self.step[last][token] = state
            last = self.link[last]
        if last < 0:
            self.link[state] = 0
        else:
            onward = self.step[last][token]
            self.link[state] = onward if self.longest[onward] == self.longest[last] + 1 else self._split(last, token, onward)
        return state

    def _split(self, last: int, token: int, onward: int) -> int:
        """A state of its own for the shorter strings of ``onward``, up to that of ``last`` and ``token``."""
        short = self._new(dict(self.step[onward]), self.longest[last] + 1)
        self.link[short], self.link[onward] = self.link[onward], short
        while last >= 0 and self.step[last].get(token) == onward:
            self.step[last][token] = short
            last = self.link[last]
        return short

    def _new(self, step: dict[int, int], longest: int) -> int:
        self.step.append(step)
        self.link.append(0)
        self.longest.append(longest)
        self.places.append(set())
        return len(self.link) - 1

    def find(self, sequence: Iterable[int]) -> int:
        """The state of ``sequence``, which must be a substring."""
        state = 0
        for token in sequence:
            state = self.step[state][token]
        return state

    def suffixes(self, state: int) -> Iterator[int]:
        """``state`` and the states of all shorter suffixes, without the root."""
        while state > 0:
            yield state
            state = self.link[state]

    def matched(self, state: int, length: int, token: int) -> tuple[int, int]:
        """State and length of the longest suffix of (a match and ``token``) that is a substring."""
        step, link = self.step, self.link
        if token in step[state]:
            return step[state][token], length + 1
        while state >= 0 and token not in step[state]:
            state = link[state]
        if state < 0:
            return 0, 0
        return step[state][token], self.longest[state] + 1
