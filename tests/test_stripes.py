import pytest
from pyspark.sql import functions as F

from conftest import rows
from termloom import (
    document_frequency,
    explode_lines,
    explode_stripes,
    merge_stripes,
    row_stripes,
    stopword_list,
    sum_stripes,
    term_frequency,
    term_stripes,
    tfidf,
    tfidf_stripes,
)

STOP = stopword_list()


def same(a, b):
    b = b.select(a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_stripes_equal_pairs(documents):
    tf = term_frequency(documents, STOP)
    lines = row_stripes(explode_lines(documents), STOP)
    merged = merge_stripes(lines)
    assert merged.count() == merged.select("doc_id").distinct().count()
    assert same(explode_stripes(merged), tf)
    assert same(explode_stripes(term_stripes(tf)), tf)
    assert same(sum_stripes(lines), tf)
    df = document_frequency(tf)
    assert same(tfidf_stripes(lines, df), tfidf(tf, df))


@pytest.mark.parametrize("shards", [1, 7, 50])
def test_every_document_has_the_same_shards(spark, shards):
    tf = spark.range(400).select(
        F.when(F.col("id") < 300, "big").otherwise(F.concat(F.lit("d"), F.col("id") % 20)).alias("doc_id"),
        F.concat(F.lit("t"), F.col("id")).alias("term"),
        (F.col("id") % 5 + 1).alias("tf"),
    )
    stripes = term_stripes(tf, shards)
    assert same(explode_stripes(stripes), tf)
    counts = dict(rows(stripes.groupBy("doc_id").count()))
    assert 0.9 * shards <= counts["big"] <= shards == max(shards, *counts.values())
    assert stripes.agg(F.max(F.size("stripe"))).first()[0] <= max(300 // shards * 2, 20)


@pytest.mark.parametrize("shards", [1, 3])
def test_stemmed_stripes_equal_stemmed_pairs(documents, shards):
    tf = term_frequency(documents, STOP, stem=True)
    lines = row_stripes(explode_lines(documents), STOP)
    assert same(sum_stripes(lines, stem=True), tf)
    assert same(explode_stripes(merge_stripes(lines, shards, stem=True)), tf)
    df = document_frequency(tf)
    assert same(tfidf_stripes(lines, df, stem=True), tfidf(tf, df))


def test_null_document_id_is_kept(spark):
    tf = spark.createDataFrame([(None, "a", 1), (1, "b", 2)], "doc_id int, term string, tf bigint")
    assert same(explode_stripes(term_stripes(tf)), tf)


def test_empty_maps_vanish(micro):
    stripes = row_stripes(micro, STOP)
    assert stripes.count() == 3
    assert {r.doc_id for r in explode_stripes(stripes).collect()} == {"d1", "d2"}


def test_shards_part_a_large_document(spark):
    tf = spark.range(0, 90_000, 1, 16).selectExpr(
        "if(id % 3 = 0, -1, id % 500) AS doc_id", "concat('t', id) AS term", "1L AS tf"
    )
    stripes = term_stripes(tf, 6)
    plan = stripes._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "hashpartitioning(doc_id" in plan
    assert stripes.agg(F.sum(F.size("stripe"))).first()[0] == 90_000
    sizes = [r.n for r in stripes.where("doc_id = -1").select(F.size("stripe").alias("n")).collect()]
    assert len(sizes) == 6 and max(sizes) < 6000
