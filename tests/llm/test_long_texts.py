"""Very long texts: the work of a task on one of 30 MB stays within bounded memory, and stretches do not change results."""

from __future__ import annotations

import random
import subprocess
import sys

import brute
import numpy as np
import pyarrow as pa
import pytest

from rentmill.llm import language_id, repeats, shingles, toxicity
from rentmill.llm.blocks import utf8_bytes

TEXT = "import numpy as np, pyarrow as pa\nwords = ' '.join(f'w{k % 999331}' for k in range(4_300_000))\ncolumn = pa.array([words])\n"
WORK = {
    "shingle_sets": "from rentmill.llm.shingles import *\nfrom rentmill.llm.blocks import utf8_bytes\nshingle_sets(*utf8_bytes(column))",
    "gram_counts": "from rentmill.llm.language_id import gram_counts\ngram_counts(column)",
    "gram_cells": "from rentmill.llm.toxicity import gram_cells\ngram_cells(column)",
    "anchors": "from rentmill.llm.repeats import *\nanchors(*utf8_bytes(column), kinds=True)",
    "licenses": "from rentmill.llm.licenses import *\nfrom rentmill.llm.license_texts import *\nScanner(PHRASES + TEXTS, 4, 0.6, 12).scan(words.encode())",
    "divergence": "from rentmill.llm.divergence import *\nfor terms in stretches(words.encode()): pass",
}


@pytest.mark.parametrize("name", WORK)
def test_a_text_of_30_mb_takes_less_than_a_gigabyte(name):
    said = "\nimport resource\nprint(len(words), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)"
    run = subprocess.run([sys.executable, "-c", TEXT + WORK[name] + said], capture_output=True, text=True, timeout=300, check=True)
    size, peak = map(int, run.stdout.split())
    assert size >= 30_000_000 and peak < 1024


def odd_column():
    rng = random.Random(8)
    texts = ["".join(rng.choice("aàb ßc  ,") for _ in range(rng.randrange(400))) for _ in range(30)] + ["", None, "x" * 300, " ", "a", "ab cd"]
    return pa.array(texts)


@pytest.fixture
def short_stretches(monkeypatch):
    def shorten(bits):
        monkeypatch.setattr(shingles, "STRETCH_BITS", bits)
        monkeypatch.setattr(repeats, "STRETCH_BITS", bits)
        for module in (language_id, toxicity):
            monkeypatch.setattr(module, "STRETCH_BYTES", 1 << bits)

    return shorten


@pytest.mark.parametrize("bits", [1, 4, 7])
def test_stretches_change_nothing(short_stretches, bits):
    column = odd_column()
    whole = shingles.shingle_sets(*utf8_bytes(column))
    counts, cells, places = language_id.gram_counts(column), toxicity.gram_cells(column), repeats.anchors(*utf8_bytes(column), kinds=True)
    assert [len(s) for s in whole] == [len(brute.shingles(t)) for t in column.to_pylist()]
    short_stretches(bits)
    assert all((a == b).all() for a, b in zip(whole, shingles.shingle_sets(*utf8_bytes(column)), strict=True))
    assert (counts == language_id.gram_counts(column)).all()
    assert all((a == b).all() for a, b in zip(cells, toxicity.gram_cells(column), strict=True))
    assert all(np.array_equal(a, b) for a, b in zip(places, repeats.anchors(*utf8_bytes(column), kinds=True), strict=True))


def test_repeats_of_texts_longer_than_a_stretch(documents, odd_texts, short_stretches):
    short_stretches(6)
    rows = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(documents(odd_texts)).collect()}
    assert rows == brute.without_repeats(odd_texts)
