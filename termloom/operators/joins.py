"""Join conditions that let the adaptive planner handle skew."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def same_value(left: Column, right: Column) -> Column:
    """``left == right`` as a join condition under which both sides are shuffled anew.

    Spark splits skewed partitions only if both sides of a join come straight from a
    shuffle. A table aggregated by the join key is partitioned by it already, would not
    be shuffled again, and a very common key would stay in one task. A struct of the
    value is a key that no aggregation is partitioned by. Nor does Spark derive null
    tests from it, which would make equal subplans differ and keep them from being shared.
    """
    return F.struct(left.alias("value")) == F.struct(right.alias("value"))
