"""Licence scans, the prefix trie and the divergence audit against plain code."""

from __future__ import annotations

import random
from collections import Counter

import brute
import pytest

from rentmill.llm import divergence, licenses, prefix_trie, queries
from rentmill.llm.license_texts import PHRASES, TEXTS, Template
from rentmill.llm.suffix_automaton import SuffixAutomaton
from rentmill.llm.tables import read_table

FOLDER = "/root/testdata/sf0.001"


# --- licences --------------------------------------------------------------------------------------------------


def test_automaton_finds_all_substrings_and_their_places():
    rng = random.Random(3)
    for _ in range(60):
        texts = [[rng.randrange(3) for _ in range(rng.randrange(12))] for _ in range(rng.randrange(1, 5))]
        automaton = SuffixAutomaton(texts)
        stream = [rng.randrange(4) for _ in range(40)]
        inside = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        state = length = 0
        for end, token in enumerate(stream, 1):
            state, length = automaton.matched(state, length, token)
            assert length == max((n for n in range(1, end + 1) if tuple(stream[end - n : end]) in inside), default=0)
            if length:
                own = stream[end - length : end]
                places = {(k, j) for k, t in enumerate(texts) for j in range(length, len(t) + 1) if t[j - length : j] == own}
                assert automaton.places[state] == places


def odd_licenses():
    mit, bsd2, bsd3 = (next(t.text for t in TEXTS if t.label == label) for label in ("mit", "bsd-2-clause", "bsd-3-clause"))
    words = mit.split()
    holes = " ".join(w for k, w in enumerate(words) if k % 19)
    texts = [
        None, "", " \n ", "MIT license", "mit\nLICENSE, mit license mit license", "the gnu General\tpublic licenses", "GNU general public license gnu",
        "CC-BY 4.0 and cc\x00by", "cc бby", "Kapache license", "apacheé license", "apache licensé", mit, mit + mit, f"x y z {bsd3} {bsd2} end",
        f"{bsd2} foreword", holes, " ".join(words[:60]), " ".join(words[60:] + words[:60]), " ".join(words[:30] + ["other"] * 40 + words[30:]),
        " ".join(words[:90] + ["other"] * 3 + words[95:]), "Licensed under CC BY-NC 4.0." * 3, "licensed under the apache license version two",
        "no " * 500 + mit + " no" * 500,
    ]
    return list(enumerate(texts))


@pytest.mark.parametrize("stretch", [1 << 20, 7])
def test_licenses_match_plain_code(spark, documents, monkeypatch, stretch):
    monkeypatch.setattr(licenses, "STRETCH_BYTES", stretch)
    docs = odd_licenses()
    rows = {r.doc_id: r for r in licenses.scan_licenses(documents(docs)).collect()}
    assert len(rows) == len(docs)
    for doc, text in docs:
        row, places = rows[doc], brute.phrase_places(text, [(p.label, p.text) for p in PHRASES])
        assert row.n_words == len(brute.license_words(text))
        assert [tuple(p) for p in row.phrases] == [(label, len(at), min(at), max(at)) for label, at in sorted(places.items())]
        spans, best = brute.license_chains(text, PHRASES + TEXTS, licenses.LEAST_WORDS, licenses.LEAST_COVERED, licenses.MOST_GAP)
        assert sorted(tuple(s) for s in row.spans) == spans
        assert row.score == (1.0 if places else best)


def test_licenses_find_parts_in_order_and_leave_others(spark, documents):
    spans = {r.doc_id: [s.label for s in r.spans] for r in licenses.scan_licenses(documents(odd_licenses())).collect()}
    assert spans[12] == ["mit"] and spans[13] == ["mit", "mit"]
    assert spans[14] == ["bsd-3-clause", "bsd-2-clause"] and spans[15] == ["bsd-2-clause"]
    assert spans[16] == ["mit"] and spans[17] == [] and spans[20] == ["mit"]


def test_licenses_of_random_word_soup(spark, documents):
    rng = random.Random(5)
    soup = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    templates = (Template("p", "a b", phrase=True), Template("q", "b", phrase=True), *(Template(f"t{k}", soup(n)) for k, n in enumerate((4, 9, 14, 14))))
    docs = [(k, soup(rng.randrange(60)).replace("c a", "x", 1)) for k in range(60)]
    for row in licenses.scan_licenses(documents(docs), templates, 2, 0.5, 3).collect():
        text = dict(docs)[row.doc_id]
        spans, best = brute.license_chains(text, templates, 2, 0.5, 3)
        places = brute.phrase_places(text, [("p", "a b"), ("q", "b")])
        assert sorted(tuple(s) for s in row.spans) == spans and row.score == (1.0 if places else best)
        assert {p.label: p.places for p in row.phrases} == {label: len(at) for label, at in places.items()}


def test_licenses_odd_tables(spark, documents):
    assert licenses.scan_licenses(documents([(1, "mit license")]).where("false")).count() == 0
    named = documents([(1, "mit license"), (1, "mit license"), (None, "cc by")]).selectExpr("*", "'x' AS spans", "1 AS n_words", "2 AS score")
    rows = licenses.scan_licenses(named).collect()
    assert Counter((r.doc_id, r.score) for r in rows) == {(1, 1.0): 2, (None, 1.0): 1}
    assert [r.score for r in licenses.scan_licenses(documents([(1, "mit license")]), ()).collect()] == [0.0]


def test_licenses_of_a_very_long_text(spark, documents):
    text = "word " * 2_000_000 + "Released under the MIT License."
    row = queries.licenses.scan_licenses(documents([(1, text)])).first()
    assert row.n_words == 2_000_005 and row.phrases[0].first == 2_000_003 and [s.label for s in row.spans] == ["mit"]


def test_license_query_counts_as_plain_code(spark):
    texts = {r.doc_id: r.text for r in read_table(spark, FOLDER, "documents").collect()}
    rows = queries.op11_licenses(spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for row in rows:
        places = brute.phrase_places(texts[row.doc_id], [(p.label, p.text) for p in PHRASES])
        every = [at for own in places.values() for at in own]
        assert (row.n_base, row.first_word, row.last_word) == (len(every), min(every, default=None), max(every, default=None))
        assert row.base_labels == ",".join(sorted(places)) and set(places) <= set(row.labels.split(","))
        assert 0 <= row.score <= 1


# --- prefix trie -----------------------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string"


def odd_turns():
    rng = random.Random(11)
    rows = []
    for conv in [*range(-45, -35), *range(0, 90), 200, 201, 203, 2**62]:
        if conv == 40:  # the conversation that 41 to 59 begin with is absent
            continue
        for turn in range(rng.randrange(1, 3) if conv % 20 == 0 else rng.randrange(1, 7)):
            rows.append((conv, turn, ("user", "assistant")[turn % 2], rng.choice(["a", "a b", "", "c d  e\n"])))
    rows += [(300, t, "user", f"w{t // 3} x") for t in range(25)] + [(301, t, "user", f"w{t // 3} x") for t in range(23)]
    rows += [(60, None, "user", "no turn"), (61, 1, None, None), (61, 1, "user", "tie"), (61, 1, "user", "tie"), (62, 0, "", None)]
    rows += [(None, 0, "user", "nobody's"), (None, None, None, None)]
    return rows


@pytest.mark.parametrize("run", [1 << 12, 2])
def test_trie_matches_plain_code(spark, monkeypatch, run):
    monkeypatch.setattr(prefix_trie, "RUN", run)
    monkeypatch.setattr(prefix_trie, "IDS_PER_PIECE", run)
    rows = odd_turns()
    table = spark.createDataFrame(rows, TURNS).repartition(5).selectExpr("*", "1 AS depth", "'x' AS n", "0 AS words", "9 AS part")
    nodes = op12(table).collect()
    assert len(nodes) == len({tuple(n) for n in nodes})
    assert {tuple(n) for n in nodes} == brute.prefix_trie(rows)


def op12(conversations):
    from pyspark.sql import functions as F

    turns = prefix_trie.numbered_turns(conversations)
    base, head = F.col("conv_id") - F.col("conv_id") % 20, F.crc32(F.col("conv_id").cast("string")) % 4
    return prefix_trie.trie(prefix_trie.with_shared_heads(turns, base, head, 3))


def test_trie_of_copies_and_of_nothing(spark):
    copies = [(k, t, "user", f"t{t}") for k in range(400) for t in range(3)]
    assert {tuple(n) for n in op12(spark.createDataFrame(copies, TURNS).repartition(7)).collect()} == brute.prefix_trie(copies)
    assert op12(spark.createDataFrame([], TURNS)).count() == 0
    assert op12(spark.createDataFrame([(None, 1, "user", "x")], TURNS)).count() == 0


# --- divergence ------------------------------------------------------------------------------------------------


def odd_corpus():
    rng = random.Random(2)
    vocabulary = ["".join(rng.choice("abcdéßΩ") for _ in range(rng.randint(1, 4))) for _ in range(60)]
    rows = []
    for k in range(300):
        lang = rng.choice(["en", "de", None, ""])
        source = rng.choice(["s1", "s10", "s2", None, "é", "z"])
        text = " ".join(rng.choices(vocabulary, weights=range(1, 61), k=rng.randrange(30)))
        rows.append((text.upper() if k % 7 == 0 else text, lang, source))
    rows += [(None, "en", "only nulls"), ("", "lone", "single"), ("a1b2-c_d", "de", "s1"), ("x", "rare", "one"), ("y", "rare", "two")]
    return rows + [("same same same", "hot", "big")] * 50 + [("same other", "hot", "small")] * 4


@pytest.mark.parametrize("small", [False, True])
def test_divergence_matches_plain_code(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(divergence, "MOST_COUNTED", 3)
        monkeypatch.setattr(divergence, "MOST_SUMS", 1)
        monkeypatch.setattr(divergence, "STRETCH_BYTES", 5)
    corpus = odd_corpus()
    docs = spark.createDataFrame(corpus, "text string, lang string, source string").repartition(6)
    docs = docs.selectExpr("*", "1 AS term", "2 AS n", "3 AS k", "4 AS p", "CAST(NULL AS long) AS doc_id")
    for least, most in ((30, 50), (3, 4)):
        found = divergence.audit(docs, least, most).collect()
        assert len(found) == len({tuple(r) for r in found})
        assert {tuple(r) for r in found} == brute.divergence(corpus, least, most)


def test_divergence_of_nothing_and_of_huge_counts(spark):
    from pyspark.sql import functions as F

    assert divergence.audit(spark.createDataFrame([], "text string, lang string, source string")).count() == 0
    n, total, terms = 30_000_000_000, 10**15 + 7, 10**7
    row = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(terms)).alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 5) // (total + 5 * terms)


def test_a_tree_corrects_a_shared_path_once():
    branch = divergence.Branch()
    import numpy as np

    rows = [([(0, 5, 1), (1, 7, 2)], 3), ([(0, 5, 1), (1, 7, 2), (2, 4, 1)], 2), ([(0, 6, 1), (2, 4, 1)], 1)]
    for path, times in rows:
        branch.insert(np.array(path), times)
    branch.close(0)
    change = lambda p, z, q, y: abs(p - q) + abs(z - y) - abs(p - y) - abs(q - z)
    assert branch.sums[1].tolist() == [5 * change(7, 2, 5, 1)]
    assert branch.sums[2].tolist() == [2 * change(4, 1, 5, 1) + change(4, 1, 6, 1), 2 * change(4, 1, 7, 2)]
