"""The trained models and the mix against plain code: TF-IDF and cosines, log-count ratios, and rates by bisection."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import grams, vector

from rentmill.llm import language_id, mixing, toxicity

LANGUAGES = {"en": "the cat and dog went to see of in it".split(), "de": "der hund und die katze gehen zu von im es".split(), "xx": "ça été où même îles".split()}


def corpus(rows=90, seed=3):
    rng = random.Random(seed)
    made = [(k, " ".join(rng.choices(LANGUAGES[lang], k=rng.randrange(1, 30))), lang) for k in range(rows) for lang in [rng.choice(sorted(LANGUAGES))]]
    return made + [(rows, "The CAT, 12 cats & ½ Dog!", "en"), (rows + 1, "Ça été   OÙ…", "xx"), (rows + 2, "", "de"), (rows + 3, None, "de"), (rows + 4, "der hund", None)]


def test_language_vectors_and_cosines(documents):
    rows = corpus()
    model = language_id.fit(documents(rows))
    usable = [grams(text) for _, text, lang in rows if text is not None and lang is not None]
    seen = Counter(d for counts in usable for d in counts)
    idf = lambda d: math.log((1 + len(usable)) / (1 + seen[d])) + 0.1
    assert model.weights == pytest.approx([idf(d) for d in range(language_id.DIMENSIONS)], rel=1e-5)
    assert model.languages == sorted(LANGUAGES) and set(model.owner) == {0, 1, 2} and len(model.owner) > 3
    assert np.linalg.norm(model.centroids, axis=1) == pytest.approx(1, abs=1e-5)
    for row in language_id.predict(documents(rows), model).collect():
        text = rows[row.doc_id][1]
        own = vector(grams(text or ""), idf)
        cosines = [sum(v * float(c[d]) for d, v in own.items()) for c in model.centroids]
        if not text:
            assert (row.lang_pred, row.score) == ("und", 0.0)
        else:
            assert row.score == pytest.approx(min(1, max(cosines)), abs=1e-5)
            assert row.lang_pred in {model.languages[model.owner[k]] for k, c in enumerate(cosines) if c > max(cosines) - 1e-5}


def test_hundreds_of_languages_stay_within_the_rows_of_the_driver(documents):
    rng = random.Random(1)
    rows = [(k, "".join(chr(0x4E00 + 40 * (k % 300) + rng.randrange(40)) for _ in range(20)), f"l{k % 300:03}") for k in range(3000)]
    model = language_id.fit(documents(rows), most_rows=900)
    assert len(model.languages) == 300 and len(model.centroids) <= 900 * 2
    found = language_id.predict(documents(rows), model).collect()
    assert np.mean([r.lang_pred == f"l{r.doc_id % 300:03}" for r in found]) > 0.9


def toxic_corpus():
    rng = random.Random(6)
    words, insults = "a fine day for some plain words about nothing much".split(), ["worthless", "idiot", "pathetic"]
    rows, labels = [], []
    for k in range(240):
        toxic = k % 3 == 0
        rows.append((k, " ".join(rng.choices(words, k=12) + ([rng.choice(insults)] if toxic else []))))
        labels.append((k, int(toxic) if k % 20 else None))
    return [*rows, (900, None), (901, ""), (902, "you idiot")], [*labels, (5000, 1), (None, 1)]


def cells(text):
    data = text.lower().encode()
    found = set()
    for n in toxicity.SIZES:
        for k in range(len(data) - n + 1):
            code = int.from_bytes(data[k : k + n], "big") + (n << 48)
            found.add((code * 0x9E3779B97F4A7C15 % 2**64) >> (64 - toxicity.CELL_BITS))
    return found


def test_toxicity_ratios_and_scores(spark, documents):
    rows, labels = toxic_corpus()
    table = documents(rows).selectExpr("*", "1 AS toxic", "2 AS score", "3 AS may_be_labelled")
    model = toxicity.fit(table, spark.createDataFrame(labels, "doc_id long, toxic int").selectExpr("*", "'x' AS text"), most_rows=100, features=300, least_rows=2)
    texts = dict(rows)
    known = [(cells(texts[d]), t) for d, t in labels if t is not None and d in texts]
    by_label = {t: Counter(c for own, of in known if of == t for c in own) for t in (0, 1)}
    size = Counter(t for _, t in known)
    ratio = {c: math.log(((by_label[1][c] + 0.5) / (size[1] + 1)) / ((by_label[0][c] + 0.5) / (size[0] + 1))) for own, _ in known for c in own}
    used = np.flatnonzero(model.weight)
    assert 0 < len(used) <= 300 and all(by_label[0][c] + by_label[1][c] >= 2 for c in used)
    # A weight is the learned factor times the cell's ratio over all labelled rows: equal columns of the data learn equal factors.
    columns = defaultdict(list)
    for c in used:
        columns[tuple(k for k, (own, _) in enumerate(known) if c in own)].append(model.weight[c] / ratio[c])
    assert any(len(f) > 1 for f in columns.values())
    assert all(f == pytest.approx([f[0]] * len(f), rel=1e-3, abs=1e-6) for f in columns.values())
    for row in toxicity.score(table, model).collect():
        total = model.bias + sum(float(model.weight[c]) for c in cells(texts[row.doc_id] or ""))
        assert row.score == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-4)
    scores = {r.doc_id: r.score for r in toxicity.score(table, model).collect()}
    assert scores[902] > 0.3 > max(scores[d] for d in (900, 901, 1, 2))


def test_rates_solve_the_balance_found_by_bisection(documents):
    rng = random.Random(9)
    rows = [(k, "w " * rng.choice([1, 2, 5, 30, 200]), "en", rng.choice(["a", "b", "c", "d", "e"])) for k in range(900)] + [(2000, None, "en", "a")]
    found = mixing.mix(documents(rows)).collect()
    sizes = {r[0]: len((r[1] or "").split()) for r in rows}
    for source in "abcde":
        own = [r for r in found if r.source == source]
        target, scale = own[0].target, sum(sizes[r.doc_id] ** 2 for r in own) / sum(sizes[r.doc_id] for r in own)

        def taken(tilt):
            return sum(sizes[r.doc_id] * min(3.0, math.exp(tilt * sizes[r.doc_id] / scale)) for r in own)

        low, high = -1000.0, 1000.0
        for _ in range(200):
            middle = (low + high) / 2
            low, high = (middle, high) if taken(middle) < target else (low, middle)
        for r in own:
            expected = 1.0 if not r.size else min(3.0, math.exp(low * r.size / scale))
            assert r.rate == pytest.approx(3.0 if target >= 3 * r.source_size and r.size else expected, rel=1e-4)


def test_a_common_source_and_size_is_split(documents):
    rows = [(k, "", "en", "hot") for k in range(500)] + [(1000 + k, "a b", "en", "hot") for k in range(700)] + [(3000 + k, "a b c", "en", "x") for k in range(90)]
    whole = mixing.mix(documents(rows)).collect()
    split = mixing.mix(documents(rows), slice_rows=40).collect()
    slices = Counter((r.source, r.size, r.slice) for r in mixing.sized(documents(rows), 40).collect())
    assert max(slices.values()) < 100 and len(slices) > 25
    assert len({s for s in Counter((r.source, r.size, r.slice) for r in mixing.sized(documents(rows)).collect())}) == 3
    for found in (whole, split):
        for source in ("hot", "x"):
            own = [r for r in found if r.source == source]
            assert abs(sum(r.taken for r in own) - own[0].target) <= 3 and all(0 <= r.copies <= 3 for r in own)
            assert {r.copies for r in own if r.size == 0} <= {1}


def test_labelled_texts_are_moved_once_and_not_stored(spark, documents, monkeypatch):
    """What is written beside the shuffle holds no text, and training rows are the same whether labels or texts are moved to each other."""
    rows, labels = toxic_corpus()
    table, given = documents([(k, text, "en") for k, text in rows]), spark.createDataFrame(labels, "doc_id long, toxic int")
    written, store = [], toxicity.stored
    monkeypatch.setattr(toxicity, "stored", lambda df, label: written.append(df.columns) or store(df, label))
    model = toxicity.fit(table, given, most_rows=100)
    assert written and not [columns for columns in written if "text" in columns]
    usable = toxicity.usable_labels(given)
    drawn = {k for (k,) in toxicity.bounded_sample(usable, "doc_id", 100, 400).select("doc_id").collect()}
    by_labels = sorted(toxicity._training_rows(table, usable, 100, 400).select("doc_id", "toxic").collect())
    assert by_labels and {k for k, _ in by_labels} == drawn & {k for k, _ in rows}
    many = usable.unionAll(spark.range(10_000, 14_000).selectExpr("id AS doc_id", "0 AS toxic"))
    assert sorted(toxicity._training_rows(table, many, 100, 400).select("doc_id", "toxic").collect()) == by_labels
    assert np.array_equal(toxicity.fit(table, many, most_rows=100).weight, model.weight)
