"""Counting inside one row: an array of values to an array of (value, count).

A row's tokens are counted where they lie, by sorting them and measuring the
runs, so no token leaves its row before it is counted and no shuffle is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions.binding import let
from termloom.functions.tokenizing import tokenize


def count_values(values: Column, value: str = "term", count: str = "tf") -> Column:
    """``array<string>`` to ``array<struct<value, count>>``, ordered by value."""

    def run_starts(ordered: Column) -> Column:
        return F.when(
            F.size(ordered) > 0,
            F.filter(
                F.sequence(F.lit(0), F.size(ordered) - 1),
                lambda i: (i == 0) | (ordered[i] != ordered[i - 1]),
            ),
        ).otherwise(F.array().cast("array<int>"))

    def runs(ordered: Column, starts: Column) -> Column:
        return F.transform(
            starts,
            lambda start, k: F.struct(
                ordered[start].alias(value),
                (F.coalesce(F.get(starts, k + 1), F.size(ordered)) - start)
                .cast("bigint")
                .alias(count),
            ),
        )

    return let(
        F.sort_array(values),
        lambda ordered: let(run_starts(ordered), lambda starts: runs(ordered, starts)),
    )


def listed(token: Column, words: Sequence[str], *, case_insensitive: bool = False) -> Column:
    """Whether a token is in a list of words; both in lower case if ``case_insensitive``.

    Spark lowers the words too, when it folds constants, so that list and table agree.
    """
    if case_insensitive:
        return F.lower(token).isin([F.lower(F.lit(w)) for w in words])
    return token.isin(list(words))


def terms_of(
    text: Column | str,
    stopwords: Sequence[str] = (),
    *,
    case_insensitive: bool = False,
    words_only: bool = False,
) -> Column:
    """Lower-cased tokens of one text without its stopwords, as ``array<string>``.

    A stopword is dropped if the token as written is in the list, so ``The`` stays
    and counts as ``the`` unless ``case_insensitive`` is set.
    """
    tokens = tokenize(text)
    if stopwords:
        tokens = F.filter(
            tokens, lambda t: ~listed(t, stopwords, case_insensitive=case_insensitive)
        )
    if words_only:
        tokens = F.filter(tokens, lambda t: F.rlike(t, F.lit(r"^\p{L}")))
    return F.transform(tokens, F.lower)


def explode_map(df: DataFrame, column: str, *keep: str, names: tuple[str, str]) -> DataFrame:
    """One row per entry of a map column, with its key and value under ``names``.

    For a plain ``explode`` Spark adds a test for empty maps, which it pushes into the
    projection that built them, so each map would be computed three times. The outer
    form has no such test; the null row it gives for an empty map is dropped after.
    """
    rows = df.select(*keep, F.explode_outer(column).alias(*names))
    return rows.where(F.col(names[0]).isNotNull())
