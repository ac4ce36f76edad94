"""Repeated and missing ids, numerals, records of two layouts, and texts made to be slow: results against plain code."""

from __future__ import annotations

import random
import time
import zlib

import brute
import pytest

from rentmill.llm import chat, exact_dedup, jaccard, language_id, nearest, repeats, secrets
from rentmill.llm.filters import flag_wanted
from rentmill.llm.tables import discard, stored, tidy


def test_nearest_of_a_query_whose_own_row_is_repeated(spark):
    rows = [(100, [1.0, 2.0])] * 12 + [(201, [1.0, 2.0]), (202, [1.0, 2.0])] + [(300 + k, [1.0, 2.0 + k / 10 + 0.1]) for k in range(20)]
    found = nearest.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1), spark.createDataFrame(rows[:1], "vec_id long, embedding array<double>"), 10)
    assert [r.vec_id for r in found.orderBy("rank").collect()] == [201, 202, *range(300, 308)]


def test_nearest_keeps_all_rows_of_a_repeated_neighbour(spark):
    rows = [(100, [1.0, 2.0])] + [(200 + k % 3, [3.0, 3.0]) for k in range(30)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    assert [r.vec_id for r in nearest.nearest(table, table.where("vec_id = 100"), 10).orderBy("rank").collect()] == [200] * 10
    assert [r.vec_id for r in nearest.nearest(table, table.where("vec_id = 100"), 25).orderBy("rank").collect()] == [200] * 10 + [201] * 10 + [202] * 5


def near_copies(n):
    words = [f"w{k}" for k in range(100)]
    return [" ".join(words[:k] + [f"x{k}"] + words[k + 1 :]) for k in range(0, 3 * n, 3)]


def test_a_row_without_id_links_and_bridges(documents):
    base = " ".join(f"w{k}" for k in range(100))
    one, two = base.replace("w10 ", "a ").replace("w50 ", "b "), base.replace("w80 ", "c ").replace("w30 ", "d ")
    rows = [(5, one), (None, base), (7, two), (9, "something else altogether here now"), (None, "nobody's own words stand here")]
    linked = brute.components([(5, one), (6, base), (7, two)])
    assert linked[7] == (96, 5) and brute.components([(5, one), (7, two)])[7] == (96, 7), "only the row without id joins them"
    found = sorted(((r.doc_id, r.component_id) for r in jaccard.similar_components(documents(rows)).collect()), key=str)
    assert found == sorted([(5, 5), (None, 5), (7, 5), (9, 9), (None, None)], key=str)
    assert sorted((r.doc_id for r in jaccard.drop_similar(documents(rows)).collect()), key=str) == [5, 9, None, None]


def test_components_of_rows_that_all_lack_an_id(documents):
    rows = [(None, t) for t in near_copies(8)] + [(3, near_copies(9)[-1])]
    assert {r.component_id for r in jaccard.similar_components(documents(rows)).collect()} == {3}


def test_repeats_of_rows_without_id_stay_their_own(documents):
    """Two texts with one CRC-32, neither of them with an id: only the one that repeats an earlier document is cut."""
    rng, seen = random.Random(1), {}
    while True:
        text = "".join(rng.choice("abcdefgh") for _ in range(70))
        if seen.setdefault(zlib.crc32(text.encode()), text) != text:
            break
    one, other = seen[zlib.crc32(text.encode())], text
    rows = {(r.kept_sha256, r.n_removed) for r in repeats.remove_repeats(documents([(1, one), (None, one), (None, other)])).collect()}
    plain = brute.without_repeats([(1, one), (2, one), (3, other)])
    assert rows == {(plain[d][3], plain[d][1]) for d in plain} and {n for _, n in rows} == {0, 70}


def test_repeats_of_one_id_in_several_rows(documents):
    rng = random.Random(4)
    make = lambda n: "".join(rng.choice("abcd ") for _ in range(n))
    passage = make(90)
    rows = [(4, make(40) + passage), (4, passage + make(30)), (2, make(60) + passage[:70]), (4, make(120)), (4, make(120))]
    found = sorted((r.doc_id, r.n_bytes, r.n_removed) for r in repeats.remove_repeats(documents(rows)).collect())
    assert found == sorted([(2, 130, 0), (4, 130, 70), (4, 120, 70), (4, 120, 0), (4, 120, 0)])


def test_numerals_are_no_letters():
    assert not any(language_id.has_letter(t) for t in ("½", "²", "①", "Ⅷ", "1 + 2 = 3", "_", "٣", "", "́"))
    assert all(language_id.has_letter(t) for t in ("½ a", "ß", "文", "ʰ", "אב"))


def test_texts_of_numerals_have_no_language(spark, documents):
    rows = [(k, f"the cat and the dog went to see number {k}", "en") for k in range(20)] + [(100 + k, f"der hund und die katze gehen zu nummer {k}", "de") for k in range(20)]
    odd = [(200, "½ ② Ⅷ", "en"), (201, None, "de"), (202, "", "de")]
    docs = documents([*rows, *odd]).selectExpr("*", "'x' AS lang_pred", "1 AS score", "2 AS rejected", "3 AS held_out")
    model = language_id.fit(docs)
    found = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(docs.select("doc_id", "text"), model).collect()}
    assert all(found[d] == ("und", 0.0) for d in (200, 201, 202)) and found[3][0] == "en"
    kept = language_id.keep_accepted(docs, model)
    assert kept.columns == docs.columns and not {r.doc_id for r in kept.collect()} & {200, 201, 202}


@pytest.mark.parametrize("extra", ["'q' AS prompt, 'a' AS completion", "'s' AS system", "array(struct('user' AS from, 'q' AS value)) AS conversations"])
def test_a_record_of_two_layouts_is_refused(spark, extra):
    record = f"SELECT 1 AS conv_id, array(struct('user' AS role, 'q' AS content)) AS messages, {extra}"
    with pytest.raises(ValueError, match="no mapping for the layout.*messages"):
        chat.canonical_turns(spark.sql(record))


def test_columns_of_no_layout_are_ignored(spark):
    for record in ("array(struct('user' AS role, 'q' AS content, 0.5 AS weight)) AS messages, 'en' AS lang, 3 AS rows", "'user' AS role, 'q' AS text, 1L AS turn, 2 AS n"):
        turns = chat.canonical_turns(spark.sql(f"SELECT 1 AS conv_id, {record}")).first().turns
        assert [(t.role, t.text) for t in turns] == [("user", "q")]


def test_of_rows_alike_in_all_that_counts_one_stays(spark):
    rows = spark.createDataFrame([(1, "a b", f"s{k}") for k in range(6)], "doc_id long, text string, source string").coalesce(1)
    assert [r.source for r in exact_dedup.drop_copies(rows).collect()] == ["s0"]


def test_base64_does_not_make_the_token_rule_slow(documents):
    text = "eyJ" * 350_000 + " eyJhbGciOi.eyJzdWIiOi.SflKxwRJSMeKKF2QT4"
    started = time.monotonic()
    (row,) = secrets.find_secrets(documents([(1, text)])).collect()
    assert time.monotonic() - started < 30
    assert [(s.kind, s.end) for s in row.spans if s.kind == "jwt"] == [("jwt", len(text))]


def test_a_filter_flags_every_wanted_row(spark):
    rows = spark.range(2000).selectExpr("id AS key", "id AS word", "'b' AS bits")
    wanted = stored(spark.range(0, 2000, 7).selectExpr("id AS key"), "wanted")
    for cells in (64, 1 << 20):
        flagged = flag_wanted(rows, "key", wanted, "hit", cells)
        assert flagged.columns == ["key", "word", "bits", "hit"] and flagged.count() == 2000
        assert flagged.where("key % 7 = 0 AND NOT hit").count() == 0
    assert flagged.where("hit").count() < 400
    assert flag_wanted(rows, "key", wanted.where("false"), "hit").where("hit").count() == 0


def test_shuffles_of_a_tidy_session_go_with_their_query(spark):
    own = tidy(spark.range(1000).selectExpr("id", "id % 10 AS k"))
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    before = blocks.shuffleStatuses().size()
    table = stored(own.groupBy("k").count(), "counts")
    assert blocks.shuffleStatuses().size() == before and table.count() == 10
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    (file, *_) = table.inputFiles()
    discard(table)
    with pytest.raises(Exception):
        spark.read.parquet(file)
