"""Writers for results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.fields import escape_field
from termloom.sinks.manifests import differences, read_manifest, write_manifest

#: Terms are most of a table. A file's distinct ones fit this dictionary more often than
#: Parquet's usual 1 MB, beyond which each row has its term in full.
_COMPACT = {"compression": "zstd", "parquet.dictionary.page.size": 8 << 20}


def write_tsv(
    df: DataFrame,
    path: str,
    columns: list[str] | None = None,
    *,
    sort: bool = False,
    mode: str = "errorifexists",
) -> None:
    """Write ``columns`` as tab-separated text without header or quoting.

    ``sort`` orders the whole output by the columns in turn, through a range
    partitioning. Nulls become empty fields. A tab, line feed, carriage return or backslash in
    a field is written as ``\\t``, ``\\n``, ``\\r`` or two backslashes, so that every row stays
    one line with its fields; other fields are written as they are.
    """
    columns = columns or df.columns
    rows = df.select(*columns)
    if sort:
        rows = rows.orderBy(*columns)
    fields = [escape_field(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns]
    rows.select(F.concat_ws("\t", *fields).alias("value")).write.mode(mode).text(path)


def write_table(
    df: DataFrame, path: str, *, mode: str = "errorifexists", resume: bool = False, made_from: dict | None = None
) -> DataFrame:
    """Write ``df`` as parquet and return it read back.

    Cuts the lineage, survives the loss of executors, and lets later joins plan
    with the true size of the table. With ``resume``, a table that an earlier run
    finished (it has a ``_SUCCESS`` file) is taken as it is, and an unfinished one replaced.

    ``made_from`` is noted beside the table: what it was made from, as text and numbers. A
    finished table with another note is neither taken nor replaced; a ``ValueError`` names what
    differs. One whose note is missing counts as unfinished.
    """
    spark = df.sparkSession
    finished = resume and _exists(spark, f"{path}/_SUCCESS")
    if finished and made_from is not None:
        before = read_manifest(spark, path)
        finished = before is not None
        if finished and (changed := differences(before, made_from)):
            raise ValueError(f"{path} was made from something else, it differs in: {', '.join(changed)}")
    if not finished:
        df.write.mode("overwrite" if resume else mode).options(**_COMPACT).parquet(path)
        if made_from is not None:
            write_manifest(spark, path, made_from)
    return spark.read.schema(df.schema).parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def shared_folder(spark: SparkSession) -> str:
    """A fresh path below a folder that the driver and all executors share.

    That is the folder named in ``spark.checkpoint.dir``, else the warehouse folder. Off a
    local master the latter must not be a local path, as each executor has its own disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        local = base.startswith(("file:", "/"))
        if local and not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{base.rstrip('/')}/termloom-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing will read again, in whatever store it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
