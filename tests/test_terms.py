import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import porter
from conftest import rows
from test_tokenizing import by_state_machine
from termloom import (
    build_index,
    count_documents,
    corpus_tfidf,
    default_stopwords,
    distinct_terms,
    document_frequency,
    explode_lines,
    idf,
    shared_folder,
    stopword_list,
    term_frequency,
    tfidf,
    tfidf_for_terms,
    top_terms_by_df,
)

STOP = stopword_list()
MICRO_TF = sorted(
    [("d1", t, 2) for t in ("the", "cat", "sat", ".")]
    + [("d1", "mat", 1)]
    + [("d2", t, 1) for t in ("don", "'", "t", "feed", "cat", "...")]
)


def brute_force(texts, stop, stem):
    """{(doc, term): tf} from an iterable of (doc, text) in plain Python."""
    counts = Counter()
    for doc, text in texts:
        for token in by_state_machine(text):
            if token not in stop:
                term = token.lower()
                counts[doc, porter.stem(term) if stem else term] += 1
    return counts


def test_micro_corpus(micro):
    tf = term_frequency(micro, STOP, stem=True)
    assert rows(tf) == MICRO_TF
    df = document_frequency(tf)
    assert dict(rows(df)) == {t: 2 if t == "cat" else 1 for _, t, _ in MICRO_TF}
    scores = {(r.doc_id, r.term): r.score for r in tfidf(tf, df).collect()}
    assert scores["d1", "the"] == pytest.approx(7.397940, abs=1e-6)
    assert scores["d1", "cat"] == pytest.approx(7.045757, abs=1e-6)
    assert scores["d1", "mat"] == pytest.approx(3.698970, abs=1e-6)
    assert scores["d2", "cat"] == pytest.approx(3.522879, abs=1e-6)
    assert [r.term for r in top_terms_by_df(df, 3).collect()] == ["'", ".", "..."]
    assert [r.term for r in top_terms_by_df(df, 1, ascending=False).collect()] == ["cat"]


@pytest.mark.parametrize("stem", [False, True])
def test_rows_lines_and_joined_stopwords_give_the_same_counts(spark, documents, stem):
    by_row = term_frequency(documents, STOP, stem=stem)
    by_line = term_frequency(explode_lines(documents), STOP, stem=stem)
    joined = term_frequency(documents, default_stopwords(spark), stem=stem)
    expected = brute_force(((r.doc_id, r.text) for r in documents.collect()), set(STOP), stem)
    for tf in (by_row, by_line, joined):
        assert {(r.doc_id, r.term): r.tf for r in tf.collect()} == expected


def test_a_document_in_several_rows_is_one_document(spark):
    corpus = spark.createDataFrame(
        [(1, "b a a"), (1, "a c"), (2, "a"), (1, "b")], "doc_id int, text string"
    )
    tf = term_frequency(corpus)
    assert rows(tf) == [(1, "a", 3), (1, "b", 2), (1, "c", 1), (2, "a", 1)]
    assert rows(document_frequency(tf)) == [("a", 2), ("b", 1), ("c", 1)]


def test_null_and_empty_texts_give_no_rows(spark):
    corpus = spark.createDataFrame([(1, None), (2, ""), (3, " \n"), (4, "a")], "doc_id int, text string")
    for tf in (term_frequency(corpus), term_frequency(corpus, ["x"], stem=True)):
        assert rows(tf) == [(4, "a", 1)]


def test_options(micro, spark):
    listed = term_frequency(micro, ["the"], case_insensitive=True, words_only=True)
    table = spark.createDataFrame([("the",)], "word string")
    joined = term_frequency(micro, table, case_insensitive=True, words_only=True)
    assert rows(listed) == rows(joined)
    assert {r.term for r in listed.collect()} == {
        "cat", "cats", "don", "feed", "mat", "on", "sat", "t"
    }


@pytest.mark.parametrize("stem", [False, True])
def test_lists_and_tables_in_mixed_case_agree(spark, stem):
    corpus = spark.createDataFrame([(1, "The the THE cat Öl ÖL öl")], "doc_id int, text string")
    words = ["The", "öL"]
    table = spark.createDataFrame([(w,) for w in words], "word string")
    options = {"case_insensitive": True, "stem": stem}
    for own, one_row in ((corpus, True), (corpus, False), (explode_lines(corpus), False)):
        for stopwords in (words, table, words * 20):
            tf = term_frequency(own, stopwords, one_row_per_document=one_row, **options)
            assert rows(tf) == [(1, "cat", 1)]


def test_idf_and_unknown_terms(spark):
    tf = spark.createDataFrame([(1, "a", 3), (1, "b", 1)], "doc_id int, term string, tf bigint")
    df = spark.createDataFrame([("a", 9999)], "term string, df bigint")
    assert idf(df).first()["idf"] == pytest.approx(0.0)
    scored = {r.term: (r.df, r.score) for r in tfidf(tf, df).collect()}
    assert scored == {"a": (9999, 0.0), "b": (0, pytest.approx(4.0))}
    assert [r.term for r in tfidf_for_terms(tf, df).collect()] == ["a"]
    assert idf(df, 99990).first()["idf"] == pytest.approx(math.log10(9.999))


def test_corpus_size_as_n(micro):
    scores = {(r.doc_id, r.term): r.score for r in corpus_tfidf(micro, STOP, n_docs="count").collect()}
    assert scores["d1", "mat"] == pytest.approx(math.log10(3 / 2))
    tf = term_frequency(micro, STOP)
    df = document_frequency(tf)
    n = count_documents(micro)
    for scored in (tfidf(tf, df, n), tfidf_for_terms(tf, df, n)):
        assert {(r.doc_id, r.term): r.score for r in scored.collect()} == scores
    assert {r.term: r.idf for r in idf(df, n).collect()}["mat"] == pytest.approx(math.log10(3 / 2))


def test_building_a_query_runs_no_job(spark, micro):
    spark.sparkContext.setJobGroup("building", "nothing may run yet")
    try:
        tf = term_frequency(micro, STOP)
        corpus_tfidf(micro, STOP, n_docs="count")
        top_terms_by_df(document_frequency(tf))
        tracker = spark.sparkContext.statusTracker()
        assert not list(tracker.getJobIdsForGroup("building"))
        tf.count()
        assert list(tracker.getJobIdsForGroup("building"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("stem", [False, True])
def test_staged_index_equals_the_single_plan(spark, documents, stem):
    index = build_index(documents, shared_folder(spark), STOP, stem=stem)
    direct = corpus_tfidf(documents, STOP, stem=stem)
    columns = direct.columns
    assert index.tfidf.select(columns).exceptAll(direct).isEmpty()
    assert index.tfidf.count() == direct.count() == index.tf.count()
    assert index.df.agg(F.sum("df")).first()[0] == index.tf.count()


def test_one_document_and_one_term_hold_a_third_of_everything(spark):
    rng = random.Random(3)
    texts = [("big", "hot " * 5 + f"w{rng.randint(0, 500)}s ...") for _ in range(1000)]
    texts += [(f"d{i}", f"hot w{i % 300} The the") for i in range(2000)]
    corpus = spark.createDataFrame(texts, "doc_id string, text string").repartition(8)
    tf = term_frequency(corpus, STOP, stem=True)
    expected = brute_force(texts, set(STOP), stem=True)
    assert {(r.doc_id, r.term): r.tf for r in tf.collect()} == expected
    df = defaultdict(int)
    for _, term in expected:
        df[term] += 1
    for common_terms in (0, 3, 100_000):
        scored = tfidf(tf, document_frequency(tf), common_terms=common_terms).collect()
        assert len(scored) == len(expected)
        for row in scored:
            score = expected[row.doc_id, row.term] * math.log10(10000 / (df[row.term] + 1))
            assert row.score == pytest.approx(score)


def test_documents_are_counted_with_and_without_terms(spark):
    corpus = spark.createDataFrame(
        [(1, "a b a"), (1, "the"), (2, None), (3, ""), (None, "b"), (None, "c"), (4, "the 42")], "doc_id int, text string"
    )
    for stopwords in (["the"], spark.createDataFrame([("the",), (None,)], "word string")):
        for options in ({}, {"stem": True}, {"words_only": True}):
            counts = term_frequency(corpus, stopwords, documents=True, **options)
            marked = counts.where("term IS NULL")
            assert sorted((r.doc_id or 0, r.tf) for r in marked.collect()) == [(i, 0) for i in range(5)]
            plain = term_frequency(corpus, stopwords, **options)
            assert sorted(map(tuple, counts.where("tf > 0").collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    one_row = corpus.where("doc_id > 1")
    marked = term_frequency(one_row, ["the"], documents=True, one_row_per_document=True)
    assert sorted(map(tuple, marked.collect()), key=str) == [(2, None, 0), (3, None, 0), (4, "42", 1), (4, None, 0)]
    scores = corpus_tfidf(corpus, ["the"], n_docs="count")
    assert rows(scores.where("term = 'a'").select("tf", "df", F.round("score", 6))) == [(2, 1, round(2 * math.log10(5 / 2), 6))]


def test_a_stem_dictionary_is_joined_to_the_counts(spark):
    corpus = spark.createDataFrame([(1, "cats cat dogs mice"), (1, "Cat"), (2, "mice mouse")], "doc_id int, text string")
    stems = [("cats", "cat"), ("dogs", "dog"), ("mice", "mouse"), ("mice", "zzz"), ("unused", "x"), ("dog", None)]
    table = spark.createDataFrame(stems, "term string, stem string")
    want = [(1, "cat", 3), (1, "dog", 1), (1, "mouse", 1), (2, "mouse", 2)]
    assert rows(term_frequency(corpus, stem=table)) == want
    assert rows(term_frequency(corpus, stem=table, one_row_per_document=True)) == want
    assert rows(term_frequency(corpus, stem=table.limit(0))) == rows(term_frequency(corpus))
    assert rows(distinct_terms(corpus, ["mice"])) == [("cat",), ("cats",), ("dogs",), ("mouse",)]
