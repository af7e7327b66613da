import random

import pytest
from pyspark.sql import functions as F

import porter
from termloom import explode_tokens, normalize, stem_vocabulary, with_stem

PUBLISHED = (
    "caresses:caress ponies:poni cats:cat feed:feed agreed:agre plastered:plaster motoring:motor "
    "sing:sing hopping:hop falling:fall hissing:hiss filing:file happy:happi sky:sky relational:relat "
    "conditional:condit rational:ration digitizer:digit hopefulness:hope electrical:electr "
    "adjustment:adjust probate:probat rate:rate controll:control roll:roll"
)


def stems(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "term string")
    return {r.term: r.stem for r in with_stem(df).collect()}


def test_published_examples(spark):
    expected = dict(pair.split(":") for pair in PUBLISHED.split())
    assert stems(spark, expected) == expected


def test_short_words_marks_and_nulls_stay(spark):
    words = ["a", "is", "as", "...", "42", "日本語", None, "s"]
    assert stems(spark, words) == {w: w for w in words}


def test_random_words_agree_with_the_paper(spark):
    rng = random.Random(1)
    suffixes = [*porter.SECOND, *porter.THIRD, *porter.FOURTH, "s", "ed", "ing", "eed", "y", "sses", "ies", "e", "ll"]
    words = {
        "".join(rng.choices("aeiouybcdlstwxzyé", k=rng.randint(0, 6)))
        + rng.choice(suffixes)
        + rng.choice(["", "s", "ed", "ing", "ly", "y", rng.choice(suffixes)])
        for _ in range(40_000)
    }
    got = stems(spark, words)
    assert got == {w: porter.stem(w) for w in words}


def test_fixture_vocabulary_agrees_with_the_paper(documents):
    vocabulary = stem_vocabulary(normalize(explode_tokens(documents))).collect()
    assert len(vocabulary) > 10_000
    assert [r for r in vocabulary if r.stem != porter.stem(r.term)] == []


def test_other_columns_pass_and_the_term_can_be_replaced(spark):
    df = spark.createDataFrame([(1, "cats", 2)], "doc_id int, term string, tf int")
    out = with_stem(df, "term", "term")
    assert sorted(out.columns) == ["doc_id", "term", "tf"]
    assert out.select("doc_id", "term", "tf").first() == (1, "cat", 2)


@pytest.mark.parametrize("how", ["inner", "left_semi", "left"])
def test_later_filters_and_joins_do_not_grow_the_plan(spark, how):
    df = spark.createDataFrame([("cats",), ("dogs",)], "term string")
    wanted = spark.createDataFrame([("cat",)], "stem string")
    out = with_stem(df).join(wanted, "stem", how).where(F.col("stem") != "dog")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 20_000
    assert [r.stem for r in out.collect()] == ["cat"]


def test_compiled_method_is_small_enough_for_the_jit(spark, capsys):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    terms = normalize(explode_tokens(documents)).withColumn("tf", F.lit(1))
    with_stem(terms, "term", "term").explain(mode="codegen")
    sizes = [
        int(part.split(";")[0]) for part in capsys.readouterr().out.split("maxMethodCodeSize:")[1:]
    ]
    assert sizes and max(sizes) < 8000


def test_any_other_column_passes_through(spark):
    names = ["w", "part", "__word", "__kept0", "stem", "term"]
    df = spark.createDataFrame([(1, 2, 3, 4, 5, "cats")], names)
    assert with_stem(df, "term", "stem").first().asDict() == {
        "w": 1, "part": 2, "__word": 3, "__kept0": 4, "term": "cats", "stem": "cat"
    }
    assert with_stem(df, "term", "term").first()["term"] == "cat"
