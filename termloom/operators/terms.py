"""Term, document and inverse document frequency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.functions.counting import count_values, listed, terms_of
from termloom.functions.scoring import DEFAULT_N_DOCS, idf_value
from termloom.functions.stemming import with_stem
from termloom.functions.tokenizing import tokenize
from termloom.operators.joins import same_value
from termloom.operators.tokens import normalize, remove_stopwords

_TOKENS = "array<string>"


def _row_counts(corpus: DataFrame, stopwords: Sequence[str], documents: bool, **options: bool) -> DataFrame:
    """Terms counted within each row of the corpus, ``(doc_id, term, tf)``; no shuffle."""
    counts = count_values(terms_of("text", stopwords, **options))
    if documents:
        marker = F.struct(F.lit(None).cast("string").alias("term"), F.lit(0).cast("bigint").alias("tf"))
        counts = F.concat(F.coalesce(counts, F.filter(F.array(marker), lambda m: F.lit(False))), F.array(marker))
    return corpus.select("doc_id", F.inline(counts))


def _occurrences(
    corpus: DataFrame,
    stopwords: Sequence[str] | DataFrame,
    documents: bool,
    *,
    case_insensitive: bool,
    words_only: bool,
) -> DataFrame:
    """One row for each occurrence of a term, ``(doc_id, term, tf)`` with tf = 1."""
    found = tokenize("text")
    if documents:
        found = F.concat(F.coalesce(found, F.array().cast(_TOKENS)), F.array(F.lit(None)).cast(_TOKENS))
    tokens = corpus.select("doc_id", F.explode(found).alias("token"))
    marker = F.col("token").isNull() if documents else F.lit(False)
    if words_only:
        tokens = tokens.where(marker | F.rlike("token", F.lit(r"^\p{L}")))
    if isinstance(stopwords, DataFrame):
        tokens = remove_stopwords(tokens, stopwords, case_insensitive=case_insensitive)
    elif stopwords:
        stopword = listed(F.col("token"), stopwords, case_insensitive=case_insensitive)
        tokens = tokens.where(marker | ~stopword)
    tf = F.col("term").isNotNull().cast("bigint") if documents else F.lit(1).cast("bigint")
    return normalize(tokens).withColumn("tf", tf)


def apply_stems(tf: DataFrame, stems: DataFrame) -> DataFrame:
    """Counts with the stems of a table ``(term, stem)`` as terms, ``(doc_id, term, tf)``.

    A term that the table lacks stays as it is, one that it holds several times has the
    smallest of its stems. The join carries no hint and a key under which very common terms
    can be split, as those of the scores.
    """
    table = stems.groupBy(F.col("term").alias("known")).agg(F.min("stem").alias("stem"))
    joined = tf.join(table, same_value(F.col("term"), F.col("known")), "left")
    stemmed = joined.select("doc_id", F.coalesce("stem", "term").alias("term"), "tf")
    return stemmed.groupBy("doc_id", "term").agg(F.sum("tf").alias("tf"))


def term_frequency(
    corpus: DataFrame,
    stopwords: Sequence[str] | DataFrame = (),
    *,
    stem: bool | DataFrame = False,
    case_insensitive: bool = False,
    words_only: bool = False,
    one_row_per_document: bool = False,
    documents: bool = False,
) -> DataFrame:
    """Occurrences of each term in each document, ``(doc_id, term, tf)``.

    Counts are added up by document and term, spread over all tasks however large one
    document is. A caller that knows each ``doc_id`` to be on one row only can declare
    ``one_row_per_document``: rows are then counted in place and nothing is shuffled.
    The declaration is not checked, and is ignored with ``stem``, a table of stopwords,
    or a corpus of lines (one with a ``line_no``).

    ``stopwords`` is a list small enough to ship with the plan, or a table
    ``(word)`` of any size, which is joined to the tokens instead. ``stem`` is true for
    Porter's stems, or a dictionary, see ``apply_stems``.

    With ``documents``, every document also has a row without a term and with tf 0, so that
    the number of documents, with or without terms, comes out of the same shuffle.
    """
    options = {"documents": documents, "case_insensitive": case_insensitive, "words_only": words_only}
    joined = isinstance(stopwords, DataFrame)
    dictionary = stem if isinstance(stem, DataFrame) else None
    stem = stem if dictionary is None else False
    one_row_per_document = one_row_per_document and dictionary is None
    final = one_row_per_document and not (stem or joined or "line_no" in corpus.columns)

    # Stemming is dear, so there the terms of a row are counted before it. Without it,
    # counting twice costs more than the partial aggregation saves by it.
    if not joined and (final or stem):
        counts = _row_counts(corpus, stopwords, **options)
    else:
        counts = _occurrences(corpus, stopwords, **options)
    if stem:
        counts = with_stem(counts, "term", "term")
    # No term is null. Saying so here keeps joins from adding the test on one side only,
    # which would make Spark compute the same counts again instead of sharing the shuffle.
    if not documents:
        counts = counts.where(F.col("term").isNotNull())
    if final:
        return counts
    counts = counts.groupBy("doc_id", "term").agg(F.sum("tf").alias("tf"))
    return counts if dictionary is None else apply_stems(counts, dictionary)


def distinct_terms(
    corpus: DataFrame,
    stopwords: Sequence[str] | DataFrame = (),
    *,
    case_insensitive: bool = False,
    words_only: bool = False,
) -> DataFrame:
    """The vocabulary of a corpus, ``(term)``; nothing is counted, duplicates go before the shuffle."""
    terms = _occurrences(corpus, stopwords, False, case_insensitive=case_insensitive, words_only=words_only)
    return terms.select("term").distinct()


def stem_vocabulary(terms: DataFrame) -> DataFrame:
    """Distinct terms with their stems, ``(term, stem)``."""
    return with_stem(terms.select("term").distinct(), "term", "stem")


def document_frequency(tf: DataFrame) -> DataFrame:
    """Number of documents holding each term, ``(term, df)``.

    ``tf`` has one row per document and term, so its rows are counted. Counting the
    never-null ``tf`` keeps the plan below equal to that of the scores, to be shared.
    """
    return tf.groupBy("term").agg(F.count("tf").alias("df"))


def idf(df: DataFrame, n_docs: float | DataFrame = DEFAULT_N_DOCS) -> DataFrame:
    """Add ``idf`` to a document frequency table; ``n_docs`` as in ``idf_value``."""
    return df.withColumn("idf", idf_value(F.col("df"), n_docs))


def top_terms_by_df(df: DataFrame, k: int = 100, *, ascending: bool = True) -> DataFrame:
    """The ``k`` terms of lowest df, or of highest; ties go by the term, so the result is stable."""
    order = F.asc("df") if ascending else F.desc("df")
    return df.orderBy(order, F.asc("term")).limit(k)
