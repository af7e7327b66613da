import pytest
from pyspark.sql import functions as F

from conftest import rows
from termloom import (
    LEXICON,
    explode_lines,
    explode_tokens,
    pos_frequency,
    pos_frequency_stripes,
    pos_stripes,
    pos_tag,
    tag_counts,
)


def test_rules(spark):
    line = "The quickly running Alice saw 42 famous cats , $ <= THEM hopelessness"
    df = spark.createDataFrame([(1, 0, line)], "doc_id int, line_no int, text string")
    tags = [(r.token, r.tag) for r in pos_tag(df).orderBy("pos").collect()]
    assert tags == [
        ("The", "DET"), ("quickly", "ADV"), ("running", "VERB"), ("Alice", "PROPN"),
        ("saw", "NOUN"), ("42", "NUM"), ("famous", "ADJ"), ("cats", "NOUN"), (",", "PUNCT"),
        ("$", "SYM"), ("<", "SYM"), ("=", "SYM"), ("THEM", "PRON"), ("hopelessness", "NOUN"),
    ]


def test_a_word_has_one_tag_in_the_lexicon():
    words = [w for ws in LEXICON.values() for w in ws]
    assert len(words) == len(set(words)) <= 200


def test_pairs_equal_stripes_and_every_token_is_tagged(documents):
    lines = explode_lines(documents)
    pairs = pos_frequency(pos_tag(lines))
    assert rows(pairs) == rows(pos_frequency_stripes(pos_stripes(lines)))
    assert pairs.agg(F.sum("n")).first()[0] == explode_tokens(documents).count()


def test_own_tagger_sees_whole_lines_in_order(spark):
    df = spark.createDataFrame(
        [(1, 0, "a b c"), (1, 1, ""), (2, 0, "d"), (3, 0, None)], "doc_id int, line_no int, text string"
    )

    def numbered(tokens):
        assert tokens
        return [f"{i + 1}of{len(tokens)}" for i in range(len(tokens))]

    expected = [
        (1, 0, 0, "a", "1of3"), (1, 0, 1, "b", "2of3"), (1, 0, 2, "c", "3of3"), (2, 0, 0, "d", "1of1")
    ]
    assert rows(pos_tag(df, tagger=numbered)) == expected
    assert rows(pos_tag(df, make_tagger=lambda: numbered)) == expected
    assert rows(pos_frequency_stripes(pos_stripes(df, tagger=numbered))) == [
        ("1of1", 1), ("1of3", 1), ("2of3", 1), ("3of3", 1)
    ]


def test_a_tagger_must_give_one_tag_per_token(spark):
    df = spark.createDataFrame([(1, 0, "a b")], "doc_id int, line_no int, text string")
    with pytest.raises(Exception, match="1 tags for 2 tokens"):
        pos_tag(df, tagger=lambda tokens: ["X"]).collect()


def test_counts_of_distinct_tokens_equal_counts_of_tagged_ones(spark, documents):
    lines = explode_lines(documents)
    assert rows(tag_counts(lines)) == rows(pos_frequency(pos_tag(lines)))

    def by_length(tokens):
        return [str(min(len(t), 3)) for t in tokens]

    own = tag_counts(lines, tagger=by_length)
    assert rows(own) == rows(pos_frequency(pos_tag(lines, tagger=by_length)))
    assert "ReadSchema: struct<text:string>" in own._jdf.queryExecution().executedPlan().toString()
