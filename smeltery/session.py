"""Session settings the tables depend on, applied only while they are needed."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Adaptive execution splits a partition value that holds most of the rows over many write tasks.
# Microsecond timestamps carry min/max statistics in the file footers, so a filter on the load
# time skips row groups; the default 96-bit form has none.
WRITE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

# Partition values that share a shuffle partition also share every task it is split into, and each
# such task writes a file per value. Many small shuffle partitions keep values apart; adaptive
# execution merges what stays small. Beyond 2000 Spark keeps only average sizes per map task.
REBALANCE_PARTITIONS = 2000

# A rebalanced task holds no more than the advisory size, so it can keep a few files open instead
# of sorting its rows; past that number Spark sorts the rest.
OPEN_WRITERS = 8

# Files whose contents are not read cost one look-up each, so a task may take many.
LISTING_SETTINGS = {"spark.sql.files.maxPartitionBytes": "64GB"}


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Apply settings for the actions inside the block, then put the caller's back.

    They hold for the whole session, so threads that write at the same time need sessions of their
    own (``spark.newSession()``).
    """
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def at_least(spark: SparkSession, key: str, value: int) -> int:
    """``value``, or what the caller has set for ``key`` if that is more."""
    held = spark.conf.get(key, None)
    return max(value, int(held)) if held else value


# A count over file footers is one number per task: one job without adaptive stages in between.
COUNT_SETTINGS = {"spark.sql.adaptive.enabled": "false"}

# (key, count) pairs compress to a few bytes, so the default advisory size puts over ten million
# keys into one reduce task, whose hash table then spills.
AUDIT_ADVISORY = 8 << 20


def audit_settings(spark: SparkSession, staged_bytes: int, advisory: int) -> dict[str, str]:
    """Settings for an audit of so many bytes: adaptive execution merges shuffle partitions but
    never adds any, so there have to be enough of them to begin with."""
    partitions = max(-(-staged_bytes // advisory), int(spark.conf.get("spark.sql.shuffle.partitions")))
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(advisory),
        first: str(at_least(spark, first, partitions)),
    }
