"""The stages one after another, each against brute force on its own input."""


import corpus_pipeline
from pyspark.sql import functions as F
from test_decontaminate import plain_marks, plain_words
from test_line_dedup import plain as plain_lines
from test_packing import check
from test_simhash import plain_components, plain_fingerprint

from termloom.llm.packing import with_sizes
from termloom.llm.queries import op10_quality
from termloom.llm.staging import stage

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    functions = dict(corpus_pipeline.STAGES)
    assert list(functions) == ["quality", "line_dedup", "simhash", "decontamination", "packing"]

    good = stage(functions["quality"](spark, docs, SF_DIR))
    votes = {r["doc_id"] for r in op10_quality(spark, SF_DIR).where("predicted = 1").collect()}
    before = {r["doc_id"]: r for r in docs.collect()}
    rows = {r["doc_id"]: r for r in good.collect()}
    assert good.columns == columns and rows == {d: before[d] for d in votes}

    lines = stage(functions["line_dedup"](spark, good, SF_DIR))
    got = sorted(((r["doc_id"], r["text"]) for r in lines.collect()), key=str)
    assert got == plain_lines([(d, r["source"], r["text"]) for d, r in rows.items()], long_words=50, alike=True)
    assert lines.columns == columns and lines.where(F.length("text") != F.col("n_chars")).count() == 0

    kept = stage(functions["simhash"](spark, lines, SF_DIR))
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in lines.collect()}
    groups = plain_components(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, g in groups.items() if d == g)
    assert kept.columns == columns

    clean = stage(functions["decontamination"](spark, kept, SF_DIR))
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    found = {r["doc_id"]: r["text"] for r in clean.collect()}
    for r in kept.collect():
        n, hit, _ = plain_marks(r["text"], items)
        if 2 * hit > n:
            assert r["doc_id"] not in found
        elif not hit:
            assert found[r["doc_id"]] == r["text"]
        else:
            assert len(plain_words(found[r["doc_id"]])) == n - hit
    assert clean.columns == columns

    packed = functions["packing"](spark, clean, SF_DIR).collect()
    check(packed, with_sizes(clean).collect())
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect()), key=str) == sorted(map(tuple, packed), key=str)


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, docs, SF_DIR)
        assert out.count() == 0
        docs = stage(out) if name != "packing" else docs


def test_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = ("__quality", "__gone", "__id", "__of", "__text", "score", "n_words", "spans", "cluster", "of")
    extra = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in names})
    plain = docs
    for name, function in corpus_pipeline.STAGES:
        plain, extra = (stage(function(spark, d, SF_DIR)) for d in (plain, extra))
        assert sorted(map(tuple, extra.select(plain.columns).collect()), key=str) == sorted(map(tuple, plain.collect()), key=str), name
        if name != "packing":
            assert extra.columns == [*docs.columns, *names]
            assert all(r[c] == f"{c}{r['doc_id']}" for r in extra.collect() for c in names)
