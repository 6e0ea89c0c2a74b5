"""Left join to a table with one row per key, safe for hot keys on the left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(BUCKETS))


def lookup(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left`` with the columns of the ``right`` row of the same key.

    ``right`` holds one row per key and usually comes out of a grouping or a
    window on it, already partitioned. Spark would then read that partitioning
    in place, and adaptive execution, which splits a hot partition only between
    two plain shuffles, could not split the left side. The hash bucket joined
    next to the key gives both sides a shuffle of their own; ``right`` is the
    small side, so its extra shuffle is cheap. Where ``right`` turns out to be
    below the broadcast threshold, Spark broadcasts it and neither matters.
    """
    return left.withColumn("_bucket", _bucket(key)).join(
        right.withColumn("_bucket", _bucket(key)), [key, "_bucket"], "left"
    ).drop("_bucket")
