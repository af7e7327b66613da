import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("termloom-tests")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def documents(spark):
    from termloom import read_corpus_parquet

    return read_corpus_parquet(spark, "/root/testdata/sf0.001/documents.parquet")


@pytest.fixture
def micro(spark):
    """Two documents with text and one of blank lines; expected values worked out by hand."""
    return spark.createDataFrame(
        [
            ("d1", "The cat sat on the mat.\nThe cats sat."),
            ("d2", "Don't feed the cat..."),
            ("d3", "\n\n"),
        ],
        "doc_id string, text string",
    )


def rows(df):
    """The rows of a small DataFrame as a sorted list of tuples."""
    return sorted(tuple(row) for row in df.collect())
