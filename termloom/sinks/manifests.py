"""What a written table was made from, beside the table."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession

#: Raise this with any change of rules that changes results.
RULES = 1
_NAME = "_MADE_FROM"


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def input_digest(df: DataFrame) -> str | None:
    """A digest of the paths, sizes and times of the files that ``df`` reads; None if it reads none.

    Folders are listed on the driver, which holds no more than Spark's own list of these files.
    """
    spark, wanted = df.sparkSession, set(df.inputFiles())
    if not wanted:
        return None
    seen = []
    for folder in {file.rsplit("/", 1)[0] for file in wanted}:
        uri = spark._jvm.java.net.URI.create(folder)
        target = spark._jvm.org.apache.hadoop.fs.Path(uri)
        for status in target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target):
            name = status.getPath().toUri().getRawPath()
            seen.append((name, status.getLen(), status.getModificationTime()))
    names = {spark._jvm.java.net.URI.create(file).getRawPath() for file in wanted}
    listed = sorted(entry for entry in seen if entry[0] in names)
    return hashlib.sha256(json.dumps(listed).encode()).hexdigest()


def write_manifest(spark: SparkSession, table: str, made_from: dict) -> None:
    target, system = _path(spark, f"{table}/{_NAME}")
    out = system.create(target, True)
    try:
        out.write(bytearray(json.dumps({"rules": RULES, **made_from}, sort_keys=True).encode()))
    finally:
        out.close()


def read_manifest(spark: SparkSession, table: str) -> dict | None:
    """What ``write_manifest`` wrote beside the table; None if there is nothing."""
    target, system = _path(spark, f"{table}/{_NAME}")
    if not system.exists(target):
        return None
    size = system.getFileStatus(target).getLen()
    stream = system.open(target)
    try:
        return json.loads(bytes(stream.readNBytes(size)))
    finally:
        stream.close()


def differences(before: dict, made_from: dict) -> list[str]:
    """The names of what differs between a manifest and what a table would be made from now."""
    now = json.loads(json.dumps({"rules": RULES, **made_from}))
    return sorted(k for k in before.keys() | now.keys() if before.get(k) != now.get(k))
