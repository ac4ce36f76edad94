"""The Jaccard join and the removal of repeated passages against plain versions."""

from __future__ import annotations

import random

import brute
import pytest

from rentmill.llm import jaccard, repeats, suffixes
from rentmill.llm.components import connected_components


def joined(docs):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_components(docs).collect()}


def test_components_match_brute_force(documents, odd_texts):
    assert joined(documents(odd_texts)) == brute.components(odd_texts)


def test_components_with_tiny_batches_and_only_heavy_or_light_sets(documents, odd_texts, setting, monkeypatch):
    setting(spark__sql__execution__arrow__maxRecordsPerBatch=3)
    expected = brute.components(odd_texts)
    monkeypatch.setattr(jaccard, "_light_boundary", lambda lists: 1 << 30)
    assert joined(documents(odd_texts)) == expected
    monkeypatch.setattr(jaccard, "_light_boundary", lambda lists: 0)
    assert joined(documents(odd_texts, 1)) == expected


def test_links_only_found_outside_the_hubs(documents):
    """A chain of texts in which each is close to the next alone."""
    rng = random.Random(3)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(160)]
    chain = []
    for k in range(24):
        chain.append((k, " ".join(base[k * 4 : k * 4 + 60])))
    rng.shuffle(chain)
    rows = [(k, text) for k, (_, text) in enumerate(chain)]
    assert joined(documents(rows)) == brute.components(rows)


def test_rows_with_one_id_or_without_an_id(documents):
    text, other = "p q r s t u v w", "k l m n o p q r"
    got = jaccard.similar_components(documents([(5, text), (3, other), (5, other), (None, text), (None, "alone is this text here")]))
    rows = sorted(((r.doc_id, r.component_id) for r in got.collect()), key=str)
    assert rows == sorted([(3, 3), (5, 3), (5, 3), (None, 3), (None, None)], key=str)


def test_drop_similar_keeps_columns_and_one_of_each_group(documents, odd_texts):
    docs = documents(odd_texts).selectExpr("*", "'x' AS node", "1 AS n", "2 AS component_id", "3 AS sig")
    kept = jaccard.drop_similar(docs)
    assert kept.columns == docs.columns
    roots = {root for _, root in brute.components(odd_texts).values()}
    assert {r.doc_id for r in kept.collect()} == roots


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 120)] + [(7, 7)]
    got = {(r.node, r.component) for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(k, 0) for k in range(41)} | {(k, 100) for k in range(100, 120)}


def test_many_template_lines(documents, monkeypatch):
    """20,000 lines with five of six shingles in common, of which none are links; ten have a longer version."""
    real = jaccard._block_links

    def bounded(rows, percent):
        assert len(rows["first"]) * len(rows["second"]) < 8 << 20
        return real(rows, percent)

    monkeypatch.setattr(jaccard, "_block_links", bounded)
    rows = [(k, f"this line is the same in all its words but{k}") for k in range(20_000)]
    rows += [(20_000 + k, f"{text} more{k}") for k, text in rows[:10]]
    assert joined(documents(rows)) == {k: (6 + k // 20_000, k % 20_000) for k, _ in rows}


def test_copies_over_several_shards_with_a_full_filter(documents, monkeypatch):
    """A full filter of first surroundings takes all copies for first ones, so that those of one line fill many shards."""
    sent = repeats._first_kinds
    monkeypatch.setattr(repeats, "_first_kinds", lambda docs, repeated: [found | fill for found, fill in zip(sent(docs, repeated), (255, 0))])
    monkeypatch.setattr(repeats, "SHARD_ROWS", 3)
    line = "this line of more than fifty bytes is in every one of these rows"
    rows = [*((k, line) for k in range(40)), *((100 + k, f"{k} begins another text in which there is much {line}") for k in range(3))]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(documents(rows[:40])).collect()}
    assert got == brute.without_repeats(rows[:40])
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(documents(rows)).collect()}
    assert got == brute.without_repeats(rows)


@pytest.mark.parametrize("shard_rows", [3, 1 << 14])
def test_repeats_match_brute_force(documents, odd_texts, monkeypatch, shard_rows):
    monkeypatch.setattr(repeats, "SHARD_ROWS", shard_rows)
    got = repeats.remove_repeats(documents(odd_texts)).collect()
    expected = brute.without_repeats(odd_texts)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == expected
    assert all((r.kept is None) == (r.n_removed == 0) for r in got)


def test_repeats_of_null_and_equal_ids(documents):
    line = "this line of more than fifty bytes is in every one of these rows"
    got = repeats.remove_repeats(documents([(4, line), (4, line), (9, line), (None, line)]))
    assert sorted((r.doc_id or -1, r.n_removed) for r in got.collect()) == [(-1, len(line)), (4, 0), (4, 0), (9, len(line))]


@pytest.mark.parametrize("text", [b"", b"a", b"banana", b"abab" * 40, b"x" * 200, bytes(random.Random(1).choices(b"ab\0", k=500))])
def test_suffix_arrays(text):
    import numpy as np

    data = np.frombuffer(text, np.uint8)
    if not text:
        return
    order = suffixes.suffix_order(data)
    assert order.tolist() == sorted(range(len(text)), key=lambda k: text[k:])
    shared = suffixes.common_prefixes(data, order, 50)
    for k in range(1, len(text)):
        a, b = text[order[k - 1] :], text[order[k] :]
        common = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
        assert shared[k] == min(common, 50)


def test_empty_tables(documents):
    empty = documents([])
    assert jaccard.similar_components(empty).collect() == []
    assert jaccard.drop_similar(empty).collect() == []
    assert repeats.remove_repeats(empty).collect() == []
