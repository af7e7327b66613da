"""TF-IDF scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions.scoring import DEFAULT_N_DOCS, idf_value
from termloom.operators.joins import same_value


def _scored(joined: DataFrame, n_docs: float | DataFrame) -> DataFrame:
    df = F.coalesce("df", F.lit(0))
    return joined.select(
        "doc_id",
        "term",
        "tf",
        df.alias("df"),
        (F.col("tf") * idf_value(F.col("df"), n_docs)).alias("score"),
    )


def _with_df(tf: DataFrame, df: DataFrame) -> DataFrame:
    """Add ``df`` to the counts, null for unknown terms."""
    known = df.select(F.col("term").alias("known_term"), "df")
    return tf.join(known, same_value(F.col("term"), F.col("known_term")), "left").drop("known_term")


def _least_common(df: DataFrame, k: int) -> DataFrame:
    """The smallest df that no more than ``k`` terms reach, as a table of one row; null if there is none.

    The window has a row for each distinct df only; n of these need at least n * n / 2 rows of counts.
    """
    alike = df.groupBy("df").agg(F.count(F.lit(1)).alias("terms"))
    reached = F.sum("terms").over(Window.orderBy(F.desc("df")))
    return alike.select("df", reached.alias("reached")).where(F.col("reached") <= k).agg(F.min("df"))


def tfidf(
    tf: DataFrame,
    df: DataFrame,
    n_docs: float | DataFrame = DEFAULT_N_DOCS,
    *,
    common_terms: int = 0,
) -> DataFrame:
    """Score every term of every document, ``(doc_id, term, tf, df, score)``.

    ``n_docs`` is a number or a one-row table, see ``idf_value``. A term missing from ``df`` has df 0. The join carries no hint: the vocabulary
    grows with the corpus, so the adaptive planner broadcasts it only if its
    measured size allows and otherwise splits the partitions of very common terms.

    With ``common_terms`` = k, the terms of highest df, k at most, are scored through a
    broadcast. They make up most of ``tf``, which is then not shuffled; the other terms are
    joined as above. ``tf`` is read twice for it, so it should be a written table.
    """
    df = df.select("term", "df")
    if not common_terms:
        return _scored(_with_df(tf, df), n_docs)
    common = F.broadcast(df.where(F.col("df") >= _least_common(df, common_terms).scalar()))
    rest = tf.join(common.select("term"), "term", "left_anti")
    return _scored(tf.join(common, "term").unionByName(_with_df(rest, df)), n_docs)


def tfidf_for_terms(
    tf: DataFrame, terms: DataFrame, n_docs: float | DataFrame = DEFAULT_N_DOCS
) -> DataFrame:
    """Scores of the terms in ``terms(term, df)`` only, such as ``top_terms_by_df`` gives.

    A table of few terms is broadcast by its size; with a large one, the partitions of
    very common terms can be split.
    """
    wanted = terms.select(F.col("term").alias("wanted_term"), "df")
    joined = tf.join(wanted, same_value(F.col("term"), F.col("wanted_term")))
    return _scored(joined.drop("wanted_term"), n_docs)
