"""From raw documents to packed training bins in five stages, each a table of its own.

Every stage works on all rows that the one before kept. Stages 1 to 4 return the columns of
``documents``; a text that changes has its ``n_chars`` counted anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.decontaminate import remove_contamination
from termloom.llm.labelled import fold
from termloom.llm.line_dedup import remove_boilerplate
from termloom.llm.packing import pack_documents, with_sizes
from termloom.llm.quality import fit_quality, score_quality
from termloom.llm.simhash import keep_one_of_each
from termloom.llm.staging import free_name, stage


def _recounted(docs: DataFrame) -> DataFrame:
    counted = F.length("text").cast(docs.schema["n_chars"].dataType)
    return docs.withColumn("n_chars", counted)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of low quality: neighbours' votes below one half.

    Null and empty texts score 0 and go; rows that repeat score alike. Without labels every
    document scores one half and stays.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_quality(docs, labels, learn=fold(F.col("doc_id"), 3) != 1)
    score = free_name(docs, "__quality")
    return score_quality(docs, model, column=score).where(F.col(score) >= 0.5).drop(score)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines that three sources or more share, but for their first place, and lines of
    over 50 words that two distinct texts or more share, but for the text of their first place.

    No document goes here; exact copies are treated alike and left for the next stage. Null texts stay null,
    null sources count for no line; ties go to the smallest ``doc_id``.
    """
    return _recounted(remove_boilerplate(docs, long_words=50, copies_alike=True))


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group: fingerprints of three-word
    shingles that differ in three bits at most, as ``op5_simhash``.

    Null and empty texts are one group; rows that repeat a ``doc_id`` stay or go together, those
    with a null one stay.
    """
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out benchmark passages, and documents that are mostly such passages.

    Null and empty texts stay; rows that repeat are treated alike.
    """
    return _recounted(remove_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into bins of 2048 words, one of a source and of the same words each.

    Null and empty texts come back in no bin; rows that repeat are packed one by one.
    """
    return pack_documents(with_sizes(docs.select("doc_id", "text", "source")))


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("simhash", simhash),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Fingerprints and votes are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and reread as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, function in STAGES:
        docs = stage(function(spark, docs, sf_dir))
    return docs
