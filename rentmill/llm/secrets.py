"""Secret scans over a trigram inverted index.

Each rule's regular expression gives a Boolean trigram query (:mod:`rentmill.llm.trigrams`). A task indexes its
documents block by block, keeping inverted lists of the trigrams that rules ask for, intersects the lists, and runs
a rule's expression only over its candidates. A rule without mandatory trigrams scans every text. Blocks are
independent, so nothing is shuffled and a lost executor costs its own blocks.

Matches of a rule are leftmost and do not overlap; those that are too short are dropped afterwards. Null texts are empty.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from rentmill.llm.blocks import text_blocks, utf8_bytes
from rentmill.llm.trigrams import PostingIndex, trigram_query, trigrams_of


@dataclass(frozen=True)
class Rule:
    """``least``: a match is dropped if ``group`` has fewer characters."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    any_case: bool = False

    @property
    def flags(self) -> int:
        return re.ASCII | (re.IGNORECASE if self.any_case else 0)


BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}", 24),  # the same as runs of any length with short ones dropped: runs are maximal
)
ADDED_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39),
    # The first run is bounded: base64 text may hold "eyJ" anywhere, and each would be read to the end of its run.
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{1,400}\.[A-Za-z0-9_-]+\.([A-Za-z0-9_-]+)", 8, 1),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)
SPANS = "spans array<struct<kind:string,start:int,end:int>>"


def find_secrets(docs: DataFrame, rules: Sequence[Rule] = BASE_RULES + ADDED_RULES) -> DataFrame:
    """doc_id and the spans of every row, by start and then by the order of the rules; code points, end exclusive."""
    rules = tuple(rules)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [trigram_query(rule.pattern, rule.flags) for rule in rules]
        index = PostingIndex(set().union(*(trigrams_of(q) for q in queries)))
        compiled = [re.compile(rule.pattern, rule.flags) for rule in rules]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for block in text_blocks(batches):
            index.fill(*utf8_bytes(block.column("text")))
            left = [index.candidates(query).tolist() for query in queries]
            spans = []
            for k, text in enumerate(block.column("text").to_pylist()):
                found = [
                    (m.start(), order, m.end())
                    for order, (rule, expression) in enumerate(zip(rules, compiled))
                    if left[order][k] and text
                    for m in expression.finditer(text)
                    if m.end(rule.group) - m.start(rule.group) >= rule.least
                ]
                spans.append([{"kind": rules[o].kind, "start": s, "end": e} for s, o, e in sorted(found)])
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])

    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {SPANS}")
