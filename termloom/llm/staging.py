"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from termloom.sinks.tables import drop_folder, shared_folder


class Stage:
    """A DataFrame written to the shared folder and read back; ``drop`` deletes it."""

    def __init__(self, df: DataFrame):
        self.spark = df.sparkSession
        self.path = shared_folder(self.spark)
        df.write.option("compression", "zstd").parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        drop_folder(self.spark, self.path)


def stage(df: DataFrame) -> DataFrame:
    """``df`` cut from its lineage; the table lives as long as the shared folder."""
    return Stage(df).df


def byte_texts(column: pa.Array | pa.ChunkedArray) -> Iterator[bytes]:
    """The values of a binary column, nulls as empty."""
    return (value or b"" for value in column.to_pylist())


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores in front as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
