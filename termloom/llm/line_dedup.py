"""Removal of lines that many sites share, by the spread of each line over sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.staging import free_name, stage
from termloom.operators.joins import same_value

#: Sketches of 2**12 registers have a relative standard error of 1.04 / 64.
LG_REGISTERS = 12
#: Estimates within so many standard errors of the threshold are replaced by exact counts.
_ERRORS = 8
NEAR = _ERRORS * 1.04 / 2 ** (LG_REGISTERS / 2)


def line_key(line: Column) -> Column:
    """What makes two lines the same: 128 bits of the text in lower case with single blanks."""
    plain = F.trim(F.regexp_replace(F.lower(line), r"\s+", " "))
    return F.unhex(F.md5(plain.cast("binary")))


def site_spread(lines: DataFrame, min_sites: int) -> DataFrame:
    """``(key)`` of the lines ``(key, site, ...)`` on at least ``min_sites`` distinct sites.

    One HyperLogLog sketch for each key, merged by aggregation, so a line on a million pages is
    a few kilobytes in each task. Estimates within eight standard errors of the threshold are
    settled by exact distinct counts of those lines alone. Null sites do not count.
    """
    # Sketches pass over empty strings, so they get the site with a mark; null stays null.
    marked = F.concat(F.lit("/"), "site")
    sketches = lines.groupBy("key").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg(marked, LG_REGISTERS)).alias("sites"),
    )
    # A line that is there fewer times than the threshold needs no further look.
    estimates = stage(sketches.where(F.col("sites") >= min_sites * (1 - NEAR)))
    sure = estimates.where(F.col("sites") > min_sites * (1 + NEAR)).select("key")
    near = estimates.where(F.col("sites") <= min_sites * (1 + NEAR)).select("key")
    pairs = lines.select("key", "site").join(
        near.withColumnRenamed("key", "of"), same_value(F.col("key"), F.col("of")), "left_semi"
    )
    # Distinct pairs first: a line with very many rows of few sites shrinks before it is shuffled.
    exact = pairs.where("site IS NOT NULL").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("sites"))
    return sure.unionByName(exact.where(F.col("sites") >= min_sites).select("key"))


def _places(lines: DataFrame, keys: DataFrame) -> DataFrame:
    """The places of the lines ``keys``, written out for both of their uses."""
    found = lines.select("id", "content", "n", "key").join(
        keys.withColumnRenamed("key", "of"), same_value(F.col("key"), F.col("of")), "left_semi"
    )
    return stage(found)


def _others(found: DataFrame, first: list[str], same: Column) -> DataFrame:
    """The places but the first of each line, and those that are the ``same`` as the first."""
    least = found.groupBy("key").agg(F.min(F.struct(*first)).alias("first")).withColumnRenamed("key", "of")
    return found.join(least, same_value(F.col("key"), F.col("of"))).where(~same)


def remove_boilerplate(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    site: str = "source",
    min_sites: int = 3,
    min_words: int = 3,
    long_words: int | None = None,
    copies_alike: bool = False,
    removed: str | None = None,
) -> DataFrame:
    """``docs`` without the lines that stand on at least ``min_sites`` distinct sites.

    Lines are cut at line feeds and compared in lower case with single blanks; those of fewer
    than ``min_words`` words always stay. The first place of each such line (the smallest
    ``doc_id``, then the first line) stays, so no text is lost altogether. ``removed`` names a
    column for the number of lines taken out.

    ``long_words`` makes every line of more words go by its spread over texts as well: on two
    distinct texts or more, whatever their sites, it stays only in the text of its first place.
    A text and its exact copies count as one and keep or lose such a line together, so they stay
    copies of each other; a line that one text repeats stays there. ``copies_alike`` does so for
    all lines: the first place stays in exact copies of its text too, for a later stage to remove.

    All rows are returned, if need be with an empty text; null texts stay null. Rows with a null
    ``doc_id`` come first in order; rows that repeat a ``doc_id`` and text are treated alike.
    Other columns may have any names.
    """
    keys = docs.select(F.col(doc_id).alias("id"), F.col(site).alias("site"), F.col(text).alias("text"))
    numbered = keys.select("id", "site", F.xxhash64("text").alias("content"), F.posexplode(F.split("text", "\n")).alias("n", "line"))
    words = F.size(F.split(F.trim("line"), r"\s+"))
    long = [] if long_words is None else [(words > long_words).alias("long")]
    lines = stage(
        numbered.where(words >= min_words).select("id", "content", "n", "site", line_key(F.col("line")).alias("key"), *long)
    )
    spread = stage(site_spread(lines.select("key", F.col("site").cast("string").alias("site")), min_sites))
    found = _places(lines, spread)
    if copies_alike:
        same_place = (F.col("content") == F.col("first.content")) & (F.col("n") == F.col("first.n"))
        others = _others(found, ["id", "n", "content"], same_place)
    else:
        others = _others(found, ["id", "n"], F.struct("id", "n").eqNullSafe(F.col("first")))
    if long:
        passages = lines.where("long")
        texts = stage(site_spread(passages.select("key", F.col("content").cast("string").alias("site")), 2))
        same_text = F.col("content") == F.col("first.content")
        passed = _others(_places(passages, texts), ["id", "n", "content"], same_text)
        others = others.select("id", "content", "n").unionByName(passed.select("id", "content", "n"))
    own_id, own_content, gone_lines = (free_name(docs, name) for name in ("__id", "__content", "__gone"))
    gone = stage(
        others.groupBy(F.col("id").alias(own_id), F.col("content").alias(own_content)).agg(F.collect_set("n").alias(gone_lines))
    )
    # Rows that repeat an id and text are one row of this table, whatever their number.
    same = F.col(doc_id).eqNullSafe(F.col(own_id)) & (F.xxhash64(text) == F.col(own_content))
    # Always by sort-merge, so that the plan is the same at every size.
    joined = docs.join(gone.hint("merge"), same, "left")
    kept = F.expr(f"filter(split(`{text}`, '\\n'), (line, n) -> NOT array_contains(`{gone_lines}`, n))")
    shorter = F.when(F.col(gone_lines).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    columns = [shorter.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns if c != removed]
    if removed:
        columns.append(F.coalesce(F.size(gone_lines), F.lit(0)).cast("bigint").alias(removed))
    return joined.select(*columns)
