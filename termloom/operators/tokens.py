"""Token rows: exploding a corpus, dropping stopwords, lower-casing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.functions.tokenizing import split_lines, tokenize
from termloom.operators.joins import same_value


def explode_lines(corpus: DataFrame) -> DataFrame:
    """One row per line, ``(doc_id, line_no, text)``, with lines counted from 0 in each row."""
    return corpus.select("doc_id", F.posexplode(split_lines("text")).alias("line_no", "text"))


def explode_tokens(corpus: DataFrame) -> DataFrame:
    """One row per token: the corpus columns without ``text``, then ``pos`` and ``token``.

    ``pos`` counts from 0 within the row. Rows without a token, null texts among
    them, vanish.
    """
    kept = [c for c in corpus.columns if c != "text"]
    return corpus.select(*kept, F.posexplode(tokenize("text")).alias("pos", "token"))


def remove_stopwords(
    tokens: DataFrame, stopwords: DataFrame, *, case_insensitive: bool = False
) -> DataFrame:
    """Drop the tokens listed in ``stopwords(word)``, compared as they are written.

    An anti join without a hint: Spark broadcasts the list if its size allows
    and otherwise shuffles, with the skew handling of the adaptive planner.
    """
    token, word = F.col("token"), F.col("word")
    if case_insensitive:
        token, word = F.lower(token), F.lower(word)
    return tokens.join(stopwords.where("word IS NOT NULL").select("word"), same_value(token, word), "left_anti")


def normalize(tokens: DataFrame) -> DataFrame:
    """Lower-cased tokens as ``(doc_id, term)``, still one row per occurrence."""
    return tokens.select("doc_id", F.lower("token").alias("term"))
