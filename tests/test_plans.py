"""The physical plans are part of the design, so they are tested."""

import re

from termloom import (
    corpus_tfidf,
    default_stopwords,
    distinct_terms,
    document_frequency,
    explode_lines,
    explode_tokens,
    pos_frequency_stripes,
    pos_stripes,
    read_corpus_parquet,
    remove_stopwords,
    row_stripes,
    shared_folder,
    stopword_list,
    sum_stripes,
    term_frequency,
    tfidf,
    tfidf_for_terms,
    tfidf_stripes,
    top_terms_by_df,
    write_table,
)

STOP = stopword_list()


def executed(df, whole=False):
    """The final adaptive plan, after running the query; ``whole`` adds the initial one."""
    query = df._jdf.queryExecution()
    query.toRdd().count()
    plan = query.executedPlan().toString()
    return plan if whole else plan.split("== Initial Plan ==")[0]


def raw(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def test_counting_documents_of_one_row_needs_no_shuffle(spark):
    tf = term_frequency(raw(spark), STOP, one_row_per_document=True)
    plan = executed(tf)
    assert "Exchange" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_df_shuffles_partial_counts_only(spark):
    plan = executed(document_frequency(term_frequency(raw(spark), STOP, one_row_per_document=True)))
    assert plan.count("Exchange hashpartitioning(term") == plan.count("Exchange ") == 1
    assert "partial_count" in plan


def test_scores_and_df_share_the_counts(spark):
    for options in ({"stem": True}, {"one_row_per_document": False}):
        tf = term_frequency(raw(spark), STOP, **options)
        plan = executed(tfidf(tf, document_frequency(tf)))
        assert "ReusedExchange" in plan
        assert plan.count("Scan parquet") == 1


def test_counted_documents_come_out_of_the_shuffle_of_the_counts(spark):
    for options in ({}, {"stem": True}):
        scores = corpus_tfidf(raw(spark).select("doc_id", "text"), STOP, n_docs="count", **options)
        lines = executed(scores, whole=True).splitlines()
        # Scans that ran stand below compiled code; the number's own plan is printed twice.
        pairs = zip(lines, lines[1:])
        ran = {re.search(r"FileScan parquet \[(.*?)\]", l)[1] for above, l in pairs if "FileScan" in l and ") ColumnarToRow" in above}
        assert len(ran) == 1
        assert sum("ReusedExchange" in l for l in lines) >= 2


def test_a_vocabulary_is_distinct_before_its_shuffle(spark):
    plan = executed(distinct_terms(raw(spark), STOP))
    assert plan.count("Exchange hashpartitioning(term") == plan.count("Exchange ") == 1
    assert plan.count("HashAggregate") == 2


def test_stripes_share_the_counts(spark):
    stripes = row_stripes(raw(spark), STOP)
    plan = executed(tfidf_stripes(stripes, document_frequency(sum_stripes(stripes))))
    assert "ReusedExchange" in plan


def test_no_array_or_map_is_computed_twice(spark):
    for df in (
        explode_tokens(raw(spark)),
        sum_stripes(row_stripes(raw(spark))),
        pos_frequency_stripes(pos_stripes(explode_lines(raw(spark)))),
        term_frequency(raw(spark)),
    ):
        plan = executed(df)
        tree = "\n".join(l for l in plan.splitlines() if "FileScan" not in l)
        assert tree.count("regexp_extract_all") == 1


def test_stopwords_are_broadcast_by_their_size(spark):
    tokens = explode_tokens(raw(spark).select("doc_id", "text"))
    plan = executed(remove_stopwords(tokens, default_stopwords(spark)))
    assert re.search(r"BroadcastHashJoin .*LeftAnti", plan)
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_top_terms_are_taken_without_a_full_sort(spark):
    tf = term_frequency(raw(spark), STOP, one_row_per_document=True)
    plan = executed(tfidf_for_terms(tf, top_terms_by_df(document_frequency(tf))))
    assert "TakeOrderedAndProject" in plan
    assert re.search(r"BroadcastHashJoin .*Inner", plan)


def test_a_large_vocabulary_is_not_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        tf = term_frequency(raw(spark), STOP, one_row_per_document=True)
        plan = executed(tfidf(tf, document_frequency(tf)))
    finally:
        spark.conf.set(key, before)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_only_uncommon_terms_are_shuffled_for_their_score(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        tf = write_table(term_frequency(raw(spark), STOP), shared_folder(spark))
        df = write_table(document_frequency(tf), shared_folder(spark))
        query = tfidf(tf, df, common_terms=1000)
        plan = executed(query, whole=True)
        assert query.count() == tf.count()
        assert 0 < df.where(f"df * 1000 > {tf.count()}").count() < 1000
    finally:
        spark.conf.set(key, before)
    assert re.search(r"BroadcastHashJoin .*Inner", plan)
    assert re.search(r"BroadcastHashJoin .*LeftAnti", plan)
    assert re.search(r"SortMergeJoin .*LeftOuter", plan)


def exchanges(df):
    """What each shuffle of the final plan deals out by, and its rows, after running the query."""
    query, found = df._jdf.queryExecution(), []
    query.toRdd().count()

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if name == "Exchange":
            found.append((node.outputPartitioning().toString(), node.metrics().apply("shuffleRecordsWritten").value()))
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(query.executedPlan())
    return found


def test_as_many_terms_as_allowed_are_scored_without_a_shuffle(spark, tmp_path):
    # One term in every document, twenty in 1 to 20 of them, a hundred in one each.
    text = "array_join(concat(array('all'), transform(filter(sequence(1, 20), k -> k > id), k -> repeat('x', k)), if(id < 100, array(repeat('y', id + 1)), array())), ' ')"
    corpus = spark.range(0, 1000, 1, 4).selectExpr("id AS doc_id", f"{text} AS text")
    tf = write_table(term_frequency(corpus), str(tmp_path / "tf"))
    df = write_table(document_frequency(tf), str(tmp_path / "df"))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        # Each number of terms allowed, and the rows of the terms beyond it; terms of one df go together.
        for k, others in ((121, 0), (120, 101), (19, 103), (1, 310)):
            scores = tfidf(tf, df, common_terms=k)
            assert sum(n for by, n in exchanges(scores) if "struct(value, term" in by) == others, k
            assert sorted(scores.collect()) == sorted(tfidf(tf, df).collect())
    finally:
        spark.conf.set(key, before)


def test_documents_dealt_out_by_id_are_counted_without_another_shuffle(spark, tmp_path):
    path = str(tmp_path / "corpus")
    rows = [(i % 50, f"cat cats dog{i}") for i in range(100)] + [(None, "cat"), (None, "cats cat"), (7, None)]
    spark.createDataFrame(rows, "doc_id int, text string").write.parquet(path)
    dealt = term_frequency(read_corpus_parquet(spark, path, partitions=3, by_document=True), stem=True)
    assert [by.split("#")[0] for by, _ in exchanges(dealt)] == ["hashpartitioning(doc_id"]
    assert sorted(dealt.collect(), key=str) == sorted(term_frequency(read_corpus_parquet(spark, path), stem=True).collect(), key=str)
    assert {(None, "cat", 3), (7, "cat", 4)} <= {tuple(r) for r in dealt.collect()}


def test_a_very_common_term_is_split_in_the_join(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        corpus = spark.range(0, 60_000, 1, 16).selectExpr(
            "id AS doc_id", "concat('hot w', id % 500, ' x', id % 499) AS text"
        )
        tf = term_frequency(corpus, one_row_per_document=True)
        df = document_frequency(tf)
        scores = tfidf(tf, df)
        plan = executed(scores)
        chosen = tfidf_for_terms(tf, df)
        chosen_plan = executed(chosen)
        assert chosen.count() == scores.count()
        # hot, w, x and two numbers each, which are the same for the first 499 documents
        assert scores.count() == 5 * 60_000 - 499
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)
    assert "SortMergeJoin(skew=true)" in plan
    assert "SortMergeJoin(skew=true)" in chosen_plan
