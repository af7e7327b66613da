"""Readers that give a corpus: rows of ``(doc_id, text)``.

A row holds a whole document or one line of it. Rows of one document need not
lie together, so a document of any size is spread over as many tasks as its
file has splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_corpus_text(
    spark: SparkSession, path: str | list[str], *, full_path: bool = False, partitions: int | None = None
) -> DataFrame:
    """One row per line of the text files under ``path``: ``(doc_id, line_no, text)``.

    ``doc_id`` is the base name of the file, so files of one name in different
    folders count as one document unless ``full_path`` is set. ``line_no`` tells
    lines apart and grows within a file split; it is not a dense count. For
    ``partitions`` see ``read_corpus_parquet``.
    """
    name = F.col("_metadata.file_path" if full_path else "_metadata.file_name")
    # Spark gives the name URL-encoded, with a plus sign left as it is.
    decoded = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    lines = spark.read.text(path)
    rows = lines.select(
        F.when(F.contains(name, F.lit("%")), decoded).otherwise(name).alias("doc_id"),
        F.monotonically_increasing_id().alias("line_no"),
        F.col("value").alias("text"),
    )
    return rows.repartition(partitions) if partitions else rows


def read_corpus_parquet(
    spark: SparkSession,
    path: str | list[str],
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    partitions: int | None = None,
    by_document: bool = False,
) -> DataFrame:
    """One row per row of a parquet table: ``(doc_id, text)``.

    Without ``partitions`` nothing is shuffled: tasks follow the splits of the files. A number
    deals the rows out to so many tasks, for files too few or too unsplittable to occupy a
    cluster. With ``by_document`` they are dealt out by id, so that counts by document and term
    are added up where they are counted and not shuffled again. All rows of one id, and all
    without one, then meet in one task, so that is for tables with few rows of each.
    """
    table = spark.read.parquet(*([path] if isinstance(path, str) else path))
    rows = table.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    keys = ["doc_id"] if by_document else []
    return rows.repartition(partitions, *keys) if partitions else rows


def count_documents(corpus: DataFrame) -> DataFrame:
    """The number of documents as a table of one row, ``(n_docs)``; a null id counts as one.

    Nothing runs until the table is used. The scoring operators take it as ``n_docs`` and
    count within their own plan.
    """
    return corpus.select("doc_id").distinct().agg(F.count(F.lit(1)).alias("n_docs"))
