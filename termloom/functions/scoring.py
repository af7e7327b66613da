"""Scalar parts of the TF-IDF score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the corpus size the score assumes unless told otherwise.
DEFAULT_N_DOCS = 10000.0


def idf_value(df: Column, n_docs: float | DataFrame = DEFAULT_N_DOCS) -> Column:
    """``log10(n_docs / (df + 1))``; a term without a df counts as df 0.

    ``n_docs`` is a number, or a table of one row and column such as ``count_documents``
    gives, which becomes a scalar subquery of the plan.
    """
    n = n_docs.scalar().cast("double") if isinstance(n_docs, DataFrame) else F.lit(float(n_docs))
    return F.log10(n / (F.coalesce(df, F.lit(0)) + 1))
