"""Readers for the side inputs: stopword lists and document frequency tables."""

from __future__ import annotations

from importlib.resources import files

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.fields import unescape_field


def stopword_list() -> list[str]:
    """The stopwords shipped with the package."""
    lines = files("termloom").joinpath("data/stopwords.txt").read_text("utf-8").splitlines()
    return [line.strip() for line in lines if line.strip() and not line.startswith("# ")]


def default_stopwords(spark: SparkSession) -> DataFrame:
    """The shipped stopwords as a one-column table, ``(word)``."""
    return spark.range(1).select(F.explode(F.lit(stopword_list())).alias("word"))


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """A stopword file with one word per line, as ``(word)``; blanks are trimmed."""
    words = spark.read.text(path).select(F.trim("value").alias("word"))
    return words.where(F.col("word") != "").distinct()


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table written by ``write_tsv``, with the columns and types of ``schema``.

    Read as plain lines, as a csv reader takes a field ``"`` for a quote. Fields come back as
    they were; an empty field is an empty string, or null in a column of another type.
    """
    fields = F.split("value", "\t")
    types = spark.createDataFrame([], schema).schema
    columns = []
    for at, field in enumerate(types.fields):
        text = unescape_field(F.get(fields, at))
        is_text = field.dataType.simpleString() == "string"
        value = text if is_text else F.nullif(text, F.lit("")).cast(field.dataType)
        columns.append(value.alias(field.name))
    return spark.read.text(path).select(*columns)


def read_df_table(spark: SparkSession, path: str) -> DataFrame:
    """A document frequency table written by ``write_tsv``, as ``(term, df)``.

    A term that stands there several times, as when a folder holds the output of two jobs,
    has its largest df.
    """
    rows = read_tsv(spark, path, "term string, df bigint")
    return rows.groupBy("term").agg(F.max("df").alias("df"))
