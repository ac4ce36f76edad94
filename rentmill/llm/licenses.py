"""License scans with a generalised suffix automaton of licence tokens.

All templates go into one automaton (:mod:`rentmill.llm.suffix_automaton`), which is built once in the driver: its size is that
of the templates, whatever the corpus. Tasks stream each text through it, a stretch at a time, and get the matching
statistics: after every word the longest run of words ending there that stands in some template.

* A phrase is found wherever its state is the current match or a suffix of it, so no place is missed.
* Where a match cannot go on and has ``least_words`` words or more, it is a long match with its places in the templates. Long
  matches are chained per template: a match goes on the open chain that covers most template words with it, if it
  lies further on in text and template and at most ``most_gap`` words on in both; words that overlap count once. A chain
  ends when the text has moved on by more than the gap. Ended chains that cover the share ``least_covered`` of their
  template are spans. Spans of one template do not overlap: the one that covers more stays, of equal ones the earlier.
  A span inside a span of another template that covers more words is part of that one and goes (a two-clause text
  inside a three-clause text).

Words are maximal runs of a-z, 0-9 and characters beyond ASCII, after A-Z is lower-cased. A text costs its UTF-8 bytes, the words of one stretch, the
matches within a gap and its spans, never all its words, and nothing is shuffled; a lost executor costs its own blocks.
Null and empty texts have no words and the score 0. Each row is judged by itself, so repeated rows give repeated results, and other columns
are ignored, whatever their names. Without templates nothing is found.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentmill.llm.blocks import text_blocks
from rentmill.llm.license_texts import PHRASES, TEXTS, Template
from rentmill.llm.suffix_automaton import SuffixAutomaton
from rentmill.llm.tables import text_of

LEAST_WORDS = 4
LEAST_COVERED = 0.6
MOST_GAP = 12

WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
STRETCH_BYTES = 1 << 20

FOUND = (
    "n_words long, phrases array<struct<label:string,places:long,first:long,last:long>>, "
    "spans array<struct<label:string,start:long,end:long,covered:double>>, score double"
)


def words_of(data: bytes) -> Iterator[list[bytes]]:
    """The words of lower-cased UTF-8, a bounded stretch at a time."""
    start = 0
    while start < len(data):
        stop = start + STRETCH_BYTES
        if stop < len(data):  # not within a word
            rest = WORD.match(data, stop)
            stop = rest.end() if rest else stop
        yield WORD.findall(data, start, stop)
        start = stop


class Chains:
    """The chains of long matches of one text with one template."""

    def __init__(self, size: int, least_covered: float, most_gap: int) -> None:
        self.size, self.least, self.gap = size, least_covered * size, most_gap
        self.open: list[list] = []  # start and end in the text, end in the template, words covered, whether a match went on it
        self.spans: list[tuple[int, int, int]] = []
        self.best = 0

    def add(self, start: int, end: int, low: int, high: int) -> None:
        """The words from ``start`` to ``end`` of the text are those from ``low`` to ``high`` of the template."""
        self.retire(start - self.gap)
        most, onto = end - start, None
        for chain in self.open:
            if chain[1] < end and chain[2] < high and low - chain[2] <= self.gap:
                covered = chain[3] + end - start - max(0, chain[1] - start, chain[2] - low)
                if covered > max(most, chain[3]):
                    most, onto = covered, chain
        if onto:
            onto[4] = True
        self.open.append([onto[0] if onto else start, end, high, most, False])

    def retire(self, before: int | None = None) -> None:
        """End the chains whose text ends before ``before``, or all."""
        kept = []
        for chain in self.open:
            if before is not None and chain[1] >= before:
                kept.append(chain)
            elif not chain[4]:
                self._ended(*chain[:4])
        self.open = kept

    def _ended(self, start: int, end: int, _: int, covered: int) -> None:
        self.best = max(self.best, covered)
        if covered < self.least:
            return
        if self.spans and start < self.spans[-1][1]:
            if covered > self.spans[-1][2]:
                self.spans[-1] = (start, end, covered)
        else:
            self.spans.append((start, end, covered))


class Scanner:
    """The automaton of some templates, and what each of its states says about them."""

    def __init__(self, templates: Sequence[Template], least_words: int, least_covered: float, most_gap: int) -> None:
        self.templates, self.settings, self.least_words = templates, (least_covered, most_gap), least_words
        texts = [[w for words in words_of(t.text.encode().lower()) for w in words] for t in templates]
        self.tokens = {w: k for k, w in enumerate(sorted({w for text in texts for w in text}))}
        coded = [[self.tokens[w] for w in text] for text in texts]
        self.sizes = [len(text) for text in coded]
        self.automaton = SuffixAutomaton(coded)
        whole: dict[int, list[int]] = {}
        for k, template in enumerate(templates):
            if template.phrase and coded[k]:
                whole.setdefault(self.automaton.find(coded[k]), []).append(k)
        states = range(len(self.automaton.link))
        self.phrases = [[k for s in self.automaton.suffixes(state) for k in whole.get(s, ())] for state in states]
        self.places = [sorted((k, end) for k, end in self.automaton.places[state] if not templates[k].phrase) for state in states]

    def scan(self, data: bytes) -> tuple[int, list[dict], list[dict], float]:
        """Words, phrases, spans and score of one text, given as lower-cased UTF-8."""
        tokens, phrases, sizes = self.tokens, self.phrases, self.sizes
        found: dict[str, list[int]] = {}
        chains: dict[int, Chains] = {}
        at = state = length = 0
        for words in words_of(data):
            for token in map(tokens.get, words):
                if token is None:
                    if length:
                        if length >= self.least_words:
                            self._chain(chains, state, length, at)
                        state = length = 0
                else:
                    before, had = state, length
                    state, length = self.automaton.matched(state, length, token)
                    if had >= self.least_words and length <= had:
                        self._chain(chains, before, had, at)
                    for k in phrases[state]:
                        if length >= sizes[k]:
                            start = at + 1 - sizes[k]
                            seen = found.setdefault(self.templates[k].label, [0, start, start])
                            seen[0] += 1
                            seen[1], seen[2] = min(seen[1], start), max(seen[2], start)
                at += 1
        if length >= self.least_words:
            self._chain(chains, state, length, at)
        for chain in chains.values():
            chain.retire()
        best = max((c.best / c.size for c in chains.values()), default=0.0)
        listed = [{"label": label, "places": n, "first": first, "last": last} for label, (n, first, last) in sorted(found.items())]
        return at, listed, self._spans(chains), 1.0 if found else best

    def _chain(self, chains: dict[int, Chains], state: int, length: int, end: int) -> None:
        for k, high in self.places[state]:
            if k not in chains:
                chains[k] = Chains(self.sizes[k], *self.settings)
            chains[k].add(end - length, end, high - length, high)

    def _spans(self, chains: dict[int, Chains]) -> list[dict]:
        """The spans of all templates without those inside one that covers more words."""
        spans = sorted(((s, e, n, k) for k, c in chains.items() for s, e, n in c.spans), key=lambda x: (x[0], -x[1], -x[2], x[3]))
        kept: list[tuple[int, int, int, int]] = []
        around: list[tuple[int, int, int, int]] = []  # kept spans that reach beyond where the sweep is
        for span in spans:
            around = [other for other in around if other[1] > span[0]]
            if not any(other[1] >= span[1] and other[2] > span[2] for other in around):
                kept.append(span)
                around.append(span)
        return [
            {"label": self.templates[k].label, "start": s, "end": e, "covered": n / self.sizes[k]} for s, e, n, k in kept
        ]


def scan_licenses(
    docs: DataFrame,
    templates: Sequence[Template] = PHRASES + TEXTS,
    least_words: int = LEAST_WORDS,
    least_covered: float = LEAST_COVERED,
    most_gap: int = MOST_GAP,
) -> DataFrame:
    """doc_id, n_words, phrases, spans and score of every row; positions are words from 0, ends exclusive.

    ``score`` is 1 where a phrase stands, else the largest share of a template that one chain covers, also one too small for a span.
    """
    scanner = Scanner(tuple(templates), least_words, least_covered, most_gap)
    kinds = [
        pa.int64(),
        pa.list_(pa.struct([("label", pa.string()), ("places", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])),
        pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("covered", pa.float64())])),
        pa.float64(),
    ]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            rows = [scanner.scan(text.as_py().lower()) for text in block.column("text")]
            columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), *columns], ["doc_id", "n_words", "phrases", "spans", "score"])

    texts = docs.select("doc_id", F.encode(text_of(), "UTF-8").alias("text"))
    return texts.mapInArrow(scan, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {FOUND}")
