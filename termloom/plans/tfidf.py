"""From a corpus to its scores."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.functions.scoring import DEFAULT_N_DOCS
from termloom.operators.scoring import tfidf
from termloom.operators.terms import document_frequency, term_frequency
from termloom.sinks.manifests import input_digest
from termloom.sinks.tables import write_table
from termloom.sources.corpus import count_documents

# A broadcast of so many terms takes about 13 MB.
COMMON_TERMS = 100_000


@dataclass(frozen=True)
class Index:
    tf: DataFrame
    df: DataFrame
    tfidf: DataFrame


def _counted(n_docs: float | str | DataFrame) -> bool:
    return isinstance(n_docs, str) and n_docs == "count"


def corpus_tfidf(
    corpus: DataFrame,
    stopwords: Sequence[str] | DataFrame = (),
    *,
    n_docs: float | str | DataFrame = DEFAULT_N_DOCS,
    **options,
) -> DataFrame:
    """TF-IDF of a corpus as one plan, ``(doc_id, term, tf, df, score)``.

    ``n_docs="count"`` counts the documents of the corpus in the shuffle of the counts, where
    each has a row of its own, so the corpus is read once. Options are those of
    ``term_frequency``. The counts are best shuffled even if every document is
    one row: the df table and the scores then share that shuffle, which costs less than
    tokenizing the corpus twice.
    """
    if _counted(n_docs):
        counts = term_frequency(corpus, stopwords, documents=True, **options)
        # Tests of the sum, which Spark cannot move below it, so that all branches share the shuffle.
        n_docs = counts.where("tf = 0").agg(F.count(F.lit(1)).alias("n_docs"))
        tf = counts.where("tf > 0")
    else:
        tf = term_frequency(corpus, stopwords, **options)
    return tfidf(tf, document_frequency(tf), n_docs)


def build_index(
    corpus: DataFrame,
    folder: str,
    stopwords: Sequence[str] | DataFrame = (),
    *,
    n_docs: float | str | DataFrame = DEFAULT_N_DOCS,
    common_terms: int = COMMON_TERMS,
    resume: bool = False,
    **options,
) -> Index:
    """TF-IDF of a corpus in three stages, each a table in ``folder``.

    The text is read and tokenized once, a lost executor costs the running stage
    only, and the last join is planned with the true size of the df table; see
    ``tfidf`` for ``common_terms``. ``folder`` must be one that all executors share.
    With ``resume``, stages that an earlier run finished there are kept. Each stage says what it
    was made from: the corpus' files with their sizes and times, the options and the version of
    the rules. If these differ now, a ``ValueError`` tells so and nothing is changed. A corpus that
    reads no files (one made in the session) is taken to be the same.
    """
    made = {"corpus": input_digest(corpus), "stopwords": _named(stopwords)}
    made |= {name: _named(value) for name, value in options.items()}
    tf = write_table(term_frequency(corpus, stopwords, **options), f"{folder}/tf", resume=resume, made_from=made)
    df = write_table(document_frequency(tf), f"{folder}/df", resume=resume, made_from=made)
    number = count_documents(corpus) if _counted(n_docs) else n_docs
    scores = tfidf(tf, df, number, common_terms=common_terms)
    made |= {"n_docs": _named(n_docs), "common_terms": common_terms}
    return Index(tf, df, write_table(scores, f"{folder}/tfidf", resume=resume, made_from=made))


def _named(value: object) -> object:
    """An option in a form that can be compared with that of another run."""
    if isinstance(value, DataFrame):
        return {"table": input_digest(value)}
    return value if isinstance(value, (bool, int, float, str)) or value is None else sorted(map(str, value))
