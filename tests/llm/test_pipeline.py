"""Every stage of the pipeline against plain code, each on what the stage before it kept."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from rentmill.llm import language_id, packing
from rentmill.llm.tables import held_out, read_table, stored

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """The documents, and what each stage returns."""
    tables = [read_table(spark, FOLDER, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(stored(stage(spark, tables[-1], FOLDER), name))
    return tables


@pytest.fixture(scope="module")
def texts(kept):
    return {r.doc_id: r.text for r in kept[0].collect()}


def ids(table):
    return Counter(r.doc_id for r in table.collect())


def test_columns_and_names(kept):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "jaccard_join", "mixing", "packing"]
    assert all(table.columns == kept[0].columns for table in kept[:-1])


def test_language_stage_keeps_what_reaches_its_limit(kept, texts):
    model = language_id.fit(kept[0].where(~held_out("doc_id", 5, 0)))
    expected, unsure = set(), set()
    for doc, text in texts.items():
        counts = brute.grams(text or "")
        own = brute.vector(counts, lambda d: float(model.weights[d]))
        cosines = [sum(v * float(c[d]) for d, v in own.items()) for c in model.centroids]
        best = int(np.argmax(cosines))
        limit = model.limits[model.owner[best], int(2 * math.log2(max(len(counts), 1)))]
        if any(map(str.isalpha, text or "")) and cosines[best] >= limit:
            expected.add(doc)
        if abs(cosines[best] - limit) < 1e-5:
            unsure.add(doc)
    assert set(ids(kept[1])) - unsure == expected - unsure and len(unsure) < 3
    assert len(expected) >= 0.98 * len(texts)


def test_exact_stage_keeps_the_longest_of_equal_texts(kept, texts):
    normal = {d: "".join(c for c in texts[d] or "" if c not in " \t\n\x0b\x0c\r") for d in ids(kept[1])}
    best = {}
    for d in sorted(normal, key=lambda d: (-len(texts[d] or ""), d)):
        best.setdefault(normal[d], d)
    assert ids(kept[2]) == Counter(best.values())


def test_jaccard_stage_keeps_one_of_a_component(kept, texts):
    assert ids(kept[3]) == Counter({root for _, root in brute.components([(d, texts[d]) for d in ids(kept[2])]).values()})


def test_mixing_stage_reaches_the_targets(kept, texts):
    before, after = {r.doc_id: r.source for r in kept[3].collect()}, ids(kept[4])
    words = {d: len(brute.words(texts[d])) for d in before}
    sizes = Counter()
    for d, source in before.items():
        sizes[source] += words[d]
    target = brute.water_level(sizes)
    assert set(after) <= set(before) and max(after.values()) <= 3
    for source in sizes:
        own = [d for d in before if before[d] == source]
        taken = sum(words[d] * after[d] for d in own)
        assert abs(taken - target[source]) <= max(words[d] for d in own)
    rows = {r.doc_id: r for r in kept[3].collect()}
    assert all(r == rows[r.doc_id] for r in kept[4].collect())


def test_packing_stage_holds_every_token_once(kept, texts):
    tokens, copies = Tokenizer.from_file(packing.TOKENIZER), ids(kept[4])
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in kept[5].collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(copies)
    for doc, own in pieces.items():
        whole = [*tokens.encode(texts[doc] or "", add_special_tokens=False).ids, 0]
        cuts = Counter((r.start, r.length) for r in own)
        assert set(cuts.values()) == {copies[doc]} and sum(n for _, n in cuts) == len(whole) == own[0].doc_tokens
        for r in own:
            part = np.array(whole[r.start : r.start + r.length], "<u4")
            assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024


def test_a_run_is_all_stages(spark, kept):
    assert corpus_pipeline.run(spark, FOLDER).count() == kept[5].count()
