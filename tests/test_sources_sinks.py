import gzip
import itertools

import pytest

from conftest import rows
from termloom import (
    build_index,
    count_documents,
    default_stopwords,
    document_frequency,
    drop_folder,
    explode_tokens,
    input_digest,
    pos_frequency,
    pos_tag,
    read_corpus_parquet,
    read_corpus_text,
    read_df_table,
    read_stopwords,
    read_tsv,
    shared_folder,
    stopword_list,
    term_frequency,
    write_table,
    write_tsv,
)


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "y").mkdir()
    (tmp_path / "x" / "one + 5% ü.txt").write_text("The cat\r\nsat here\rnow", "utf-8")
    (tmp_path / "y" / "one + 5% ü.txt").write_text("cat\n\n", "utf-8")
    with gzip.open(tmp_path / "x" / "b.txt.gz", "wt") as f:
        f.write("dog cat\n")
    return str(tmp_path)


def test_text_lines_take_the_file_name_as_document(spark, folder):
    corpus = read_corpus_text(spark, [f"{folder}/x", f"{folder}/y"])
    assert corpus.columns == ["doc_id", "line_no", "text"]
    assert sorted((r.doc_id, r.text) for r in corpus.collect()) == [
        ("b.txt.gz", "dog cat"),
        ("one + 5% ü.txt", ""), ("one + 5% ü.txt", "The cat"), ("one + 5% ü.txt", "cat"),
        ("one + 5% ü.txt", "now"), ("one + 5% ü.txt", "sat here"),
    ]
    assert corpus.select("line_no").distinct().count() == 6
    assert count_documents(corpus).first()[0] == 2
    assert ("one + 5% ü.txt", "cat", 2) in rows(term_frequency(corpus))
    full = read_corpus_text(spark, [f"{folder}/x", f"{folder}/y"], full_path=True)
    assert count_documents(full).first()[0] == 3


def test_tags_over_text_lines(spark, folder):
    corpus = read_corpus_text(spark, f"{folder}/x")
    assert sum(n for _, n in rows(pos_frequency(pos_tag(corpus)))) == explode_tokens(corpus).count()


def test_stopword_file(spark, tmp_path):
    path = tmp_path / "stop.txt"
    path.write_bytes(b"a\r\n\r\nde \r\nain't\r\na\r\n")
    assert rows(read_stopwords(spark, str(path))) == [("a",), ("ain't",), ("de",)]


def test_shipped_stopwords(spark):
    words = stopword_list()
    assert len(words) == len(set(words)) == 354
    assert {r.word for r in default_stopwords(spark).collect()} == set(words)


AWKWARD = ['"', "\\", "#", "'", 'a"b', "_", "NULL", "null", '\\"', ","]


def test_tsv_round_trip_keeps_awkward_terms(spark, tmp_path):
    df = spark.createDataFrame([(t, i) for i, t in enumerate(AWKWARD)], "term string, df bigint")
    write_tsv(df, str(tmp_path / "df"))
    assert rows(read_df_table(spark, str(tmp_path / "df"))) == rows(df)


def test_marks_that_end_fields_and_lines_come_back(spark, tmp_path):
    marks = ["\t", "\n", "\r", "\\", "t", "n", "r", ""]
    fields = ["".join(p) for n in range(5) for p in itertools.product(marks, repeat=n)] + ["a\tb\\", "é\r\n日本", "plain"]
    df = spark.createDataFrame([(f, i, i / 8) for i, f in enumerate(fields)], "doc string, n int, score double")
    write_tsv(df.repartition(3), str(tmp_path / "out"))
    schema = "doc string, n int, score double"
    assert rows(read_tsv(spark, str(tmp_path / "out"), schema)) == rows(df)
    lines = [line for part in (tmp_path / "out").glob("part-*") for line in part.read_bytes().split(b"\n")[:-1]]
    assert len(lines) == len(fields) and all(line.count(b"\t") == 2 and b"\r" not in line for line in lines)
    # Fields that need no escape stand there as they are, and what others wrote is read as it is.
    assert any(line.startswith(b"plain\t") for line in lines)
    (tmp_path / "own").mkdir()
    (tmp_path / "own" / "x").write_text("\\\t3\na\\b\t4\n\\\"\t\n")
    got = read_tsv(spark, str(tmp_path / "own"), "term string, df bigint").collect()
    assert sorted(map(tuple, got), key=str) == [('\\"', None), ("\\", 3), ("a\\b", 4)]


def test_nulls_become_empty_fields(spark, tmp_path):
    df = spark.createDataFrame([(None, None, 1.5), ("", 2, None)], "a string, b int, c double")
    write_tsv(df, str(tmp_path / "out"))
    assert sorted(map(tuple, read_tsv(spark, str(tmp_path / "out"), "a string, b int, c double").collect()), key=str) == [("", 2, None), ("", None, 1.5)]


def test_a_repeated_term_has_its_largest_df(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 5), ("a", 3)], "term string, df bigint")
    write_tsv(df, str(tmp_path / "df"))
    assert rows(read_df_table(spark, str(tmp_path / "df"))) == [("a", 3), ("b", 5)]


def test_readers_shuffle_only_if_told_to(spark, folder):
    documents = "/root/testdata/sf0.001/documents.parquet"
    for read, path in ((read_corpus_text, f"{folder}/x"), (read_corpus_parquet, documents)):
        plain = read(spark, path)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plain
        dealt = read(spark, path, partitions=3)._jdf.queryExecution().executedPlan().toString()
        assert "RoundRobinPartitioning(3)" in dealt


def test_a_null_id_is_one_document(spark):
    corpus = spark.createDataFrame([(None, "a"), (None, "b"), (1, "a")], "doc_id int, text string")
    assert count_documents(corpus).first()[0] == 2
    tf = term_frequency(corpus)
    assert dict(rows(document_frequency(tf))) == {"a": 2, "b": 1}


def test_finished_stages_are_kept_on_request(spark):
    corpus = spark.createDataFrame([(1, "a b"), (2, "a")], "doc_id int, text string")
    folder = shared_folder(spark)
    first = rows(build_index(corpus, folder).tfidf)
    # The scores are not finished; the counts are, so another corpus does not change them.
    drop_folder(spark, f"{folder}/tfidf/_SUCCESS")
    again = build_index(corpus.limit(0), folder, resume=True)
    assert rows(again.tfidf) == first
    with pytest.raises(Exception, match="exist"):
        build_index(corpus, folder)


def test_stages_of_another_corpus_or_other_options_are_not_taken(spark, tmp_path):
    corpus = str(tmp_path / "corpus")
    spark.createDataFrame([(1, "running cats"), (2, "cat")], "doc_id int, text string").write.parquet(corpus)
    read = lambda: read_corpus_parquet(spark, corpus)
    folder = shared_folder(spark)
    first = rows(build_index(read(), folder, ["a"], stem=True).tfidf)
    drop_folder(spark, f"{folder}/tfidf/_SUCCESS")
    assert rows(build_index(read(), folder, ["a"], stem=True, resume=True).tfidf) == first
    for stopwords, options, name in ((["a"], {}, "stem"), (["b"], {"stem": True}, "stopwords"), (["a"], {"stem": True, "n_docs": 5}, "n_docs")):
        with pytest.raises(ValueError, match=name):
            build_index(read(), folder, stopwords, resume=True, **options)
    # A table without its note is unfinished, and made again.
    drop_folder(spark, f"{folder}/df/_MADE_FROM")
    assert rows(build_index(read(), folder, ["a"], stem=True, resume=True).tfidf) == first
    spark.createDataFrame([(3, "cat dog")], "doc_id int, text string").write.mode("append").parquet(corpus)
    with pytest.raises(ValueError, match="corpus"):
        build_index(read(), folder, ["a"], stem=True, resume=True)
    assert rows(spark.read.parquet(f"{folder}/tfidf")) == first
    assert input_digest(read()) == input_digest(read().where("doc_id > 1"))
    assert input_digest(spark.range(3).toDF("doc_id")) is None


def test_sorted_tsv_is_in_order_over_all_files(spark, tmp_path):
    df = spark.createDataFrame([(f"t{i:03}", i, 0.5) for i in range(300)], "k string, n int, s double")
    write_tsv(df.repartition(5), str(tmp_path / "out"), ["k", "s"], sort=True)
    parts = sorted((tmp_path / "out").glob("part-*"))
    lines = [line for part in parts for line in part.read_text().splitlines()]
    assert lines == [f"t{i:03}\t0.5" for i in range(300)]


def test_table_comes_back_and_is_not_overwritten(spark):
    path = shared_folder(spark)
    df = spark.createDataFrame([(1, "a")], "doc_id int, term string")
    assert rows(write_table(df, path)) == rows(df)
    with pytest.raises(Exception, match="exist"):
        write_table(df, path)


def test_shared_folder_lies_below_the_session_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark).startswith(base)
    assert shared_folder(spark) != shared_folder(spark)
