import random
import unicodedata

import pytest

from termloom import explode_lines, explode_tokens, normalize, remove_stopwords, tokenize
from conftest import rows


def char_class(c):
    category = unicodedata.category(c)
    if category.startswith("L"):
        return "letter"
    if category == "Nd":
        return "digit"
    if category.startswith("Z") or c in "\t\n\x0b\f\r\x1c\x1d\x1e\x1f":
        return None
    return c


def by_state_machine(text):
    tokens, state = [], None
    for c in text:
        kind = char_class(c)
        if kind is not None:
            if kind == state:
                tokens[-1] += c
            else:
                tokens.append(c)
        state = kind
    return tokens


def tokens_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    found = dict(df.select("i", tokenize("text")).collect())
    return [found[i] for i in range(len(texts))]


VECTORS = {
    "a.b...c d__e": ["a", ".", "b", "...", "c", "d", "__", "e"],
    "don't 3.14 42nd": ["don", "'", "t", "3", ".", "14", "42", "nd"],
    "--\t==!?": ["--", "==", "!", "?"],
    "x y": ["x", "y"],
    "x y": ["x", "y"],
    "": [],
}


def test_vectors(spark):
    assert tokens_of(spark, list(VECTORS)) == list(VECTORS.values())


def test_random_text_agrees_with_a_state_machine(spark):
    rng = random.Random(7)
    alphabet = "aZé日٣7 \t\n.-_'!? ́😀\x1c\x85$"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(400)]
    assert tokens_of(spark, texts) == [by_state_machine(t) for t in texts]


@pytest.mark.parametrize("unit", ["-", "ab", "7"])
def test_a_very_long_run_is_one_token(spark, unit):
    text = unit * 1_000_000
    assert tokens_of(spark, [text]) == [[text]]


def test_lines_do_not_change_the_tokens(documents):
    whole = explode_tokens(documents).groupBy("doc_id", "token").count()
    lined = explode_tokens(explode_lines(documents)).groupBy("doc_id", "token").count()
    assert whole.exceptAll(lined).isEmpty() and lined.exceptAll(whole).isEmpty()


def test_positions_and_line_ends(spark):
    df = spark.createDataFrame([(1, "a b\r\nc\rd\n\ne"), (2, None)], "doc_id int, text string")
    tokens = explode_tokens(explode_lines(df))
    assert rows(tokens) == [(1, 0, 0, "a"), (1, 0, 1, "b"), (1, 1, 0, "c"), (1, 2, 0, "d"), (1, 4, 0, "e")]


def test_stopwords_are_compared_as_written(spark, micro):
    stop = spark.createDataFrame([("the",), ("on",)], "word string")
    tokens = explode_tokens(micro)
    kept = {r.token for r in remove_stopwords(tokens, stop).collect()}
    assert "The" in kept and "the" not in kept and "on" not in kept
    kept = {r.token for r in remove_stopwords(tokens, stop, case_insensitive=True).collect()}
    assert "The" not in kept
    assert {r.term for r in normalize(tokens).collect()} >= {"the", "cat", "don"}
