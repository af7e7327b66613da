"""Stripes: the terms of a document held as one map from term to count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.functions.counting import count_values, explode_map, terms_of
from termloom.functions.scoring import DEFAULT_N_DOCS
from termloom.functions.stemming import with_stem
from termloom.operators.scoring import tfidf


def row_stripes(corpus: DataFrame, stopwords: Sequence[str] = (), **options) -> DataFrame:
    """One map per row of the corpus, ``(doc_id, stripe)``; no shuffle.

    Options are those of ``terms_of``.
    """
    counts = count_values(terms_of("text", stopwords, **options))
    return corpus.select("doc_id", F.map_from_entries(counts).alias("stripe"))


def explode_stripes(stripes: DataFrame) -> DataFrame:
    """Map entries as rows, ``(doc_id, term, tf)``."""
    return explode_map(stripes, "stripe", "doc_id", names=("term", "tf"))


def sum_stripes(stripes: DataFrame, *, stem: bool = False) -> DataFrame:
    """Entries of all maps of a document added up by term, ``(doc_id, term, tf)``.

    With ``stem``, terms are stemmed first, so the same shuffle adds up what shares a stem.
    """
    entries = explode_stripes(stripes)
    if stem:
        entries = with_stem(entries, "term", "term").where(F.col("term").isNotNull())
    return entries.groupBy("doc_id", "term").agg(F.sum("tf").alias("tf"))


def term_stripes(tf: DataFrame, shards: int = 1) -> DataFrame:
    """Term frequencies as maps, ``(doc_id, shard, stripe)``.

    Every document has up to ``shards`` maps, its terms dealt by a hash, whatever its
    size. Choose so many that the largest document's terms, divided by them, are a map
    that a task can hold.
    """
    dealt = tf.select("doc_id", F.pmod(F.xxhash64("term"), F.lit(shards)).alias("shard"), "term", "tf")
    # Partitioned by both columns: by doc_id alone, all shards would share a task.
    return (
        dealt.repartition("doc_id", "shard")
        .groupBy("doc_id", "shard")
        .agg(F.map_from_entries(F.collect_list(F.struct("term", "tf"))).alias("stripe"))
    )


def merge_stripes(stripes: DataFrame, shards: int = 1, *, stem: bool = False) -> DataFrame:
    """Merge all maps of a document, adding their values by key; see ``term_stripes``."""
    return term_stripes(sum_stripes(stripes, stem=stem), shards)


def tfidf_stripes(
    stripes: DataFrame,
    df: DataFrame,
    n_docs: float | DataFrame = DEFAULT_N_DOCS,
    *,
    stem: bool = False,
) -> DataFrame:
    """Score the terms of stripes, merged or not; equal to ``tfidf`` on the same counts."""
    return tfidf(sum_stripes(stripes, stem=stem), df, n_docs)
