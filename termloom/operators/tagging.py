"""Part-of-speech tags and their frequencies."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.functions.binding import let
from termloom.functions.counting import count_values, explode_map
from termloom.functions.tagging import tag_token
from termloom.functions.tokenizing import tokenize
from termloom.operators.tokens import explode_tokens

Tagger = Callable[[list[str]], list[str]]


def _tagged_lines(lines: DataFrame, make_tagger: Callable[[], Tagger] | None) -> DataFrame:
    """The line columns without ``text``, then ``tokens`` and ``tags``, both arrays."""
    kept = [c for c in lines.columns if c != "text"]
    tokens = lines.select(*kept, tokenize("text").alias("tokens"))
    if make_tagger is None:

        def by_rule(token: Column, position: Column) -> Column:
            return let(F.lower(token), lambda lowered: tag_token(token, lowered, position))

        return tokens.withColumn("tags", F.transform("tokens", by_rule))

    at = tokens.columns.index("tokens")
    tags = T.StructField("tags", T.ArrayType(T.StringType()))
    schema = T.StructType([*tokens.schema.fields, tags])

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = make_tagger()
        for batch in batches:
            # All tokens of a batch as one list, and where in it each line ends; null lines are empty.
            flat = batch.column(at).flatten().to_pylist()
            ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(at)), 0).to_numpy(zero_copy_only=False))
            found: list[str] = []
            for start, end in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=False):
                if end > start:
                    own = list(tagger(flat[start:end]))
                    if len(own) != end - start:
                        raise ValueError(f"the tagger gave {len(own)} tags for {end - start} tokens")
                    found += own
            offsets = pa.array([0, *ends.tolist()], pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(found, pa.string()))
            yield pa.record_batch([*batch.columns, lists], names=schema.names)

    return tokens.mapInArrow(tag, schema)


def pos_tag(
    lines: DataFrame,
    *,
    tagger: Tagger | None = None,
    make_tagger: Callable[[], Tagger] | None = None,
) -> DataFrame:
    """Tag every token: the line columns without ``text``, then ``pos, token, tag``.

    Without a tagger the rules of ``tag_token`` decide. A ``tagger`` takes the tokens
    of one line in order and returns as many tags; ``make_tagger`` builds one per
    task, for taggers that are slow to load or cannot be pickled.
    """
    make = (lambda: tagger) if tagger else make_tagger
    if make is None:
        tokens = explode_tokens(lines).withColumn("lowered", F.lower("token"))
        tag = tag_token(F.col("token"), F.col("lowered"), F.col("pos"))
        return tokens.withColumn("tag", tag).drop("lowered")
    kept = [c for c in lines.columns if c != "text"]
    pairs = F.arrays_zip("tokens", "tags")
    return (
        _tagged_lines(lines, make)
        .select(*kept, F.posexplode(pairs).alias("pos", "pair"))
        .select(*kept, "pos", F.col("pair.tokens").alias("token"), F.col("pair.tags").alias("tag"))
    )


def pos_frequency(tagged: DataFrame) -> DataFrame:
    """Number of tokens with each tag, ``(tag, n)``."""
    return tagged.groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


def tag_counts(
    lines: DataFrame,
    *,
    tagger: Tagger | None = None,
    make_tagger: Callable[[], Tagger] | None = None,
) -> DataFrame:
    """Tag frequencies straight from lines, ``(tag, n)``; equal to ``pos_frequency(pos_tag(lines))``.

    The rules look at a token and at whether it is the first of its line, so distinct pairs
    of the two are counted first and each is tagged once. For a tagger of one's own, only
    tokens go to Python and only tags come back.
    """
    make = (lambda: tagger) if tagger else make_tagger
    if make is not None:
        tags = _tagged_lines(lines.select("text"), make).select(F.explode("tags").alias("tag"))
        return pos_frequency(tags)
    tokens = lines.select(F.posexplode(tokenize("text")).alias("pos", "token"))
    place = F.least("pos", F.lit(1)).alias("place")
    pairs = tokens.select("token", place).groupBy("token", "place").agg(F.count(F.lit(1)).alias("n"))
    pairs = pairs.withColumn("lowered", F.lower("token"))
    tag = tag_token(F.col("token"), F.col("lowered"), F.col("place")).alias("tag")
    return pairs.select(tag, "n").groupBy("tag").agg(F.sum("n").alias("n"))


def pos_stripes(
    lines: DataFrame,
    *,
    tagger: Tagger | None = None,
    make_tagger: Callable[[], Tagger] | None = None,
) -> DataFrame:
    """One map from tag to count per line: the line columns without ``text``, then ``stripe``."""
    tagged = _tagged_lines(lines, (lambda: tagger) if tagger else make_tagger)
    stripe = F.map_from_entries(count_values(F.col("tags"), "tag", "n"))
    return tagged.select(*[c for c in lines.columns if c != "text"], stripe.alias("stripe"))


def pos_frequency_stripes(stripes: DataFrame) -> DataFrame:
    """Tag counts from per-line maps, ``(tag, n)``; equal to ``pos_frequency``."""
    entries = explode_map(stripes, "stripe", names=("tag", "n"))
    return entries.groupBy("tag").agg(F.sum("n").alias("n"))
