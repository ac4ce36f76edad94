from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Build a documents table from (doc_id, text) or (doc_id, text, lang, source) rows."""

    def build(rows, partitions=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(partitions)

    return build


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty and white texts, a very long one, copies, near copies of several closenesses and shared passages."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdefghijklmnopéß") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    make = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    texts = [None, "", " \t\n\x0b\r ", "one", "One", "a b c d", "a b c d e", "A  B\nC D E", "a b c d e f", " ".join(make(30_000))]
    template, passage = make(120), make(25)
    for edits in (0, 0, 1, 1, 2, 2, 3, 3, 4, 4, 5, 6, 8, 10, 12, 15):
        words = list(template)
        for place in rng.sample(range(len(words)), edits):
            words[place] = rng.choice(vocabulary)
        texts.append(" ".join(words))
    for n in (5, 20, 60, 200):
        words = make(n)
        texts.append(" ".join([*words[: n // 2], *passage, *words[n // 2 :]]))
    texts += [" ".join(template[:-k]).upper() for k in (1, 3, 9, 20)]
    texts += ["x" * 130, "x" * 49, "x" * 50, "y" + "x" * 60, " ".join(make(40)), " ".join(make(300)[:200])]
    return list(enumerate(texts))
