"""Bounded samples of labelled documents to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def sample_labelled(
    docs: DataFrame, labels: DataFrame, *, label: str, rows: int, learn: Column, doc_id: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, float]:
    """``(text, label)`` of at most ``rows`` labelled documents, and the share of label 1.

    ``learn`` says which rows of ``labels`` may be learnt from. Half the rows at most are of
    either label, those with the smallest hashes of their ids, so the sample does not depend on
    order or partitions; the share is that among all rows that may be learnt from. An id with
    several labels counts with the smallest, one with several texts likewise. Labels other than
    0 and 1, null labels and null ids are not used.
    """
    usable = labels.where(learn & F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
    single = usable.groupBy(F.col(doc_id).alias("__id")).agg(F.min(label).cast("int").alias("__label"))
    counts = {r["__label"]: r["count"] for r in single.groupBy("__label").count().collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    order = (F.xxhash64("__id"), F.col("__id"))
    parts = [single.where(F.col("__label") == value).orderBy(*order).limit(rows // 2) for value in (0, 1)]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))  # bounded by ``rows``
    whole = docs.select(F.col(doc_id).alias("__of"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    found = whole.join(chosen, F.col("__of") == F.col("__id"))
    texts = found.groupBy("__id", "__label").agg(F.min("__text").alias("__text"))
    return texts.select(F.col("__text").alias("text"), F.col("__label").alias("label")), share
